from almanac.streaming.monthly import monthly_sales_stream, start

__all__ = ["monthly_sales_stream", "start"]
