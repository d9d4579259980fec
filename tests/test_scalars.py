from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallychain.functions import scalars as S
from tallychain.sources.sample_ledger import KINDS, kind_flag


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_hashes(spark):
    row = one(spark, empty=S.hash32(F.lit("")), none=S.hash32(F.lit(None).cast("string")), some=S.hash32(F.lit("0aFF")),
              text=S.to_hex(F.unhex(F.lit("0AFF"))), missing=S.to_hex(F.lit(None).cast("binary")))
    assert bytes(row.empty) == bytes(row.none) == b"\x00" * 32
    assert bytes(row.some) == b"\x0a\xff"
    assert (row.text, row.missing) == ("0aff", "")


def test_months_cross_the_year(spark):
    dec = F.lit(datetime(2020, 12, 31, 23, 59)).cast("timestamp_ntz")
    jan = F.lit(date(2021, 1, 1))
    row = one(spark, start=S.month_start(dec), after=S.next_month(dec), before=S.prev_month(jan), number=S.month_id(dec),
              time=S.format_time(dec), month=S.format_month(dec))
    assert (row.start, row.after, row.before) == (date(2020, 12, 1), date(2021, 1, 1), date(2020, 12, 1))
    assert (row.number, row.time, row.month) == (202012, "2020-12-31 23:59:00", "2020-12")


def test_coins_are_exact(spark):
    row = one(spark, big=S.to_coin(F.lit(2100000000000001)), small=S.to_coin(F.lit(-1)))
    assert (row.big, row.small) == (Decimal("21000000.00000001"), Decimal("-0.00000001"))


def test_owner_address(spark):
    listed = F.array(F.lit("x"), F.lit("y"))
    none = F.array().cast("array<string>")
    zero, one_, two = F.lit(0), F.lit(1), F.lit(2)
    row = one(
        spark,
        first=S.owner_address(two, listed, zero, F.lit("AB"), two),
        carrier=S.owner_address(zero, none, one_, F.lit("AB"), two),
        made=S.owner_address(zero, none, zero, F.lit("AB"), two),
        count_only=S.owner_address(one_, none, zero, F.lit("AB"), two),
    )
    assert tuple(row) == ("x", "", "_AB_2", "")


def test_script_class_order_and_fallback(spark):
    kinds = spark.range(20).withColumnRenamed("id", "kind")
    got = kinds.select("kind", S.script_type_in(kind_flag).alias("i"), S.script_type_out(kind_flag).alias("o")).collect()
    assert {r.kind: (r.o, r.i) for r in got} == {k: v[1:] for k, v in KINDS.items()}
    both = spark.createDataFrame([(True, True)], "is_p2sh boolean, is_multisig boolean")
    flags = {"is_p2sh", "is_multisig"}
    label = S.script_type_out(lambda f: F.col(f) if f in flags else F.lit(None).cast("boolean"))
    assert both.select(label.alias("t")).first().t == "p2sh"
