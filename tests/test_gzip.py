"""Gzip of messages: frames as the gzip module makes them."""

import gzip

import pyarrow as pa

from optiontide.sources import chains as SC

TEXTS = ["", "{}", "ä" * 700, '{"symbol":"P1","mark":1.25}' * 30, "x" * 40_000, "".join(chr(33 + i * i % 90) for i in range(300_000))]


def test_frames_are_read_by_gzip_and_are_no_larger_than_its_own():
    packed = SC._gzip.func(pa.array([*TEXTS, None])).to_pylist()
    assert [gzip.decompress(p).decode() for p in packed[:-1]] == TEXTS and packed[-1] is None
    assert all(len(p) <= 1.01 * len(gzip.compress(t.encode(), 6)) + 8 for p, t in zip(packed, TEXTS))
    assert SC._gunzip.func(pa.array(packed, pa.binary())).to_pylist() == [*TEXTS, None]


def test_odd_frames_are_read_as_the_gzip_module_reads_them():
    one = gzip.compress(b"one")
    odd = [b"", one + gzip.compress(b"two"), one + b"\0\0", one + b"rest", one[:-3], one[:12], b"no frame", gzip.compress(b"\xff\xfe"), None, one]
    assert SC._gunzip.func(pa.array(odd, pa.binary())).to_pylist() == ["", "onetwo", "one", None, None, None, None, None, None, "one"]



def test_only_the_contract_fields_asked_for_are_parsed(spark):
    text = '{"symbol":"Q","underlyingPrice":5,"callExpDateMap":{"e":{"1.0":[{"symbol":"c","mark":1.25,"bid":1}]}},"putExpDateMap":{}}'
    messages = spark.createDataFrame([(SC._zipped(text.encode()),)], "value binary")
    full, some = SC.decode_chain_payload(messages), SC.decode_chain_payload(messages, fields=("symbol", "mark"))
    at = "callExpDateMap['e']['1.0'][0]"
    assert some.selectExpr(f"{at} AS c").select("c.*").columns == ["mark", "symbol"]
    assert some.selectExpr("symbol", "underlyingPrice", f"{at}.mark").first() == full.selectExpr("symbol", "underlyingPrice", f"{at}.mark").first()
