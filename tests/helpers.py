import datetime as dt

from pyspark.sql import functions as F

from spindle.schemas import MESSAGE

T0 = dt.datetime(2025, 2, 1, 23, 47, 36)


def messages_df(spark, payloads, publish_time=T0):
    """Broker messages from raw byte payloads (str payloads are UTF-8 encoded)."""
    rows = []
    for i, p in enumerate(payloads):
        b = p.encode("utf-8") if isinstance(p, str) else p
        rows.append((bytearray(b), {"batch_id": "b1"}, None, f"m{i}", i))
    df = spark.createDataFrame(
        rows, "value binary, attributes map<string,string>, ordering_key string, message_id string, i int")
    ts = F.lit(publish_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return df.select("value", "attributes", "ordering_key", "message_id",
                     (ts + F.make_dt_interval(secs=F.col("i"))).alias("publish_time")) \
        .select(*MESSAGE.fieldNames())
