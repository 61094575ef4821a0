from quire.functions.varbyte import varbyte_decode, varbyte_hex, varbyte_size
from pyspark.sql import functions as F


def test_varbyte_hex_known_values(spark):
    vals = [0, 1, 127, 128, 300, 16384]
    df = spark.createDataFrame([(v,) for v in vals], "x BIGINT")
    got = [r[0] for r in df.select(varbyte_hex("x")).collect()]
    assert got == ["00", "01", "7F", "8001", "AC02", "808001"]


def test_varbyte_size(spark):
    vals = [0, 127, 128, 16383, 16384, 2097151, 2097152, 2 ** 31 - 1, 2 ** 40, 2 ** 62]
    df = spark.createDataFrame([(v,) for v in vals], "x BIGINT")
    got = [r[0] for r in df.select(varbyte_size("x")).collect()]
    want = [max(1, -(-v.bit_length() // 7)) for v in vals]
    assert got == want


def test_varbyte_round_trip(spark):
    vals = [0, 5, 127, 128, 300, 16384, 2 ** 31 - 1, 2 ** 40 + 17, 2 ** 62 + 3]
    df = spark.createDataFrame([(vals,)], "xs ARRAY<BIGINT>")
    payload = F.unhex(F.array_join(F.transform("xs", lambda x: varbyte_hex(x)), ""))
    got = df.select(varbyte_decode(payload).alias("d")).first()["d"]
    assert got == vals
    size = df.select(F.octet_length(payload)).first()[0]
    assert size == sum(max(1, -(-v.bit_length() // 7)) for v in vals)


def test_decode_truncated_tail(spark):
    # a payload cut after continuation bytes still yields its tail
    df = spark.createDataFrame([(bytes([0x05, 0x81]),)], "p BINARY")
    assert df.select(varbyte_decode("p")).first()[0] == [5, 1]
