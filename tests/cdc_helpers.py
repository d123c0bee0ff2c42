"""What the change-data tests share besides fixtures."""

import json

SF_SMALL = "/root/testdata/sf0.001"


def envelope(op, key, ts_ms, pos=None, file="mysql-bin.000001", before=None, after=None, db="sales",
             table="orders", key_col="order_id", snapshot="false", wrapped=True, extra=None):
    """One Debezium-style JSON line (helper fields: source ts = ts - 10)."""
    img = {key_col: None if key is None else str(key), **(extra or {})}
    if op == "d":
        before = before if before is not None else img
    elif op in ("u",):
        before = before if before is not None else img
        after = after if after is not None else img
    else:
        after = after if after is not None else img
    source = {"connector": "mysql", "db": db, "table": table, "ts_ms": ts_ms - 10, "file": file,
              "pos": pos, "server_id": 1}
    if snapshot is not None:
        source["snapshot"] = snapshot
    payload = {"before": before, "after": after, "source": source, "op": op, "ts_ms": ts_ms}
    return json.dumps({"payload": payload} if wrapped else payload)
