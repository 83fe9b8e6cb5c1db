from edumart.streaming.landing import extract_stream, land, land_arrivals, parquet_stream  # noqa: F401
