"""Hand-made nested blocks for small cases."""

from datetime import datetime, timedelta, timezone

from tallychain import schemas

START = datetime(2020, 1, 1, tzinfo=timezone.utc)


def tx_name(label):
    return format(abs(hash_text(label)), "064x")


def hash_text(label):
    return int.from_bytes(str(label).encode().ljust(8, b"_")[:24], "big")


def block_hash(n, branch=""):
    return tx_name(f"block{n}{branch}")


def output(value, *addresses, **flags):
    return {"value": value, "script_hex": "aa", "addresses": [{"address": a, "type": "t"} for a in addresses], **flags}


def spend(tx, index=0):
    return {"prev_tx_hash": tx_name(tx), "prev_tx_index": index, "sequence_number": 1, "script_hex": "bb", "witnesses": [], "size": 41}


def coinbase():
    return {"prev_tx_hash": schemas.ZERO_HASH, "prev_tx_index": schemas.COINBASE_INDEX, "sequence_number": 1,
            "script_hex": "", "witnesses": [b"\x01\x02"], "size": 41}


def tx(label, inputs, outputs):
    first = bool(inputs) and inputs[0]["prev_tx_hash"] == schemas.ZERO_HASH
    return {"tx_id": tx_name(label), "is_coinbase": first, "is_segwit": False, "inputs": inputs, "outputs": outputs}


def block(n, txs, days=None, parent=None, name=None, height=True):
    return {
        "block_hash": name or block_hash(n), "n_block": n if height else None,
        "block_timestamp": START + timedelta(days=n if days is None else days), "version": 1,
        "prev_block_hash": parent if parent is not None else (block_hash(n - 1) if n else ""),
        "merkle_root": tx_name(f"m{n}"), "nonce": n, "bits": 1, "size": 100, "weight": 400, "transactions": txs,
    }


def _fill(value, dtype):
    """Dicts completed with NULLs, as tuples in schema order."""
    from pyspark.sql import types as T

    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return tuple(_fill(value.get(f.name), f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return [_fill(v, dtype.elementType) for v in value]
    return value


def nested(spark, blocks):
    return spark.createDataFrame([_fill(b, schemas.NESTED_BLOCK) for b in blocks], schemas.NESTED_BLOCK)


def chain(length, days=None, height=True):
    """Block k mints 50 to ``miner`` and, from block 1 on, moves the previous coin to ``a<k>``."""
    days = days or {}
    blocks = []
    for n in range(length):
        txs = [tx(f"cb{n}", [coinbase()], [output(50, "miner")])]
        if n:
            txs.append(tx(f"mv{n}", [spend(f"cb{n - 1}")], [output(30, f"a{n}"), output(20, "miner")]))
        blocks.append(block(n, txs, days=days.get(n), height=height))
    return blocks


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def turnover_rows(store):
    return rows(store.read("turnover"), "n_block", "time", "tx_id", "address", "sats", "is_coinbase")


def month_rows(store):
    return rows(store.read("turnover_m"), "time_month", "address", "sats", "value")
