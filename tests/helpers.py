"""Change records written by hand, as the connector would send them."""

import base64
import json


def event(op, after=None, before=None):
    return json.dumps({"before": before, "after": after, "op": op})


def decimal(unscaled, scale):
    size = max(1, (unscaled.bit_length() + 8) // 8)
    raw = unscaled.to_bytes(size, "big", signed=True)
    return {"scale": scale, "value": base64.b64encode(raw).decode()}


def records(spark, values, topic="t", partition=0, first=0):
    """One record per value (text or None), offsets counted from ``first``."""
    rows = [
        (None, None if v is None else bytearray(v.encode()), topic, partition, first + i, None)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    )


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
