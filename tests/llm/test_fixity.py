import hashlib

from pyspark.sql import functions as F

from oreflow.llm import fixity

SCHEMA = "segment long, at long, record_id string, length long, digest string"


def test_records_have_the_shape_of_the_format(spark):
    pages = spark.createDataFrame([(1, "http://a/é", "<p>ü</p>"), (None, None, None)], "page_id long, url string, html string")
    found = {r.key: bytes(r.record) for r in fixity.archived(pages).collect()}
    head, body = found[1].split(b"\r\n\r\n", 1)
    assert body == "<p>ü</p>\r\n\r\n".encode() and b"Content-Length: 9" in head and head.startswith(b"WARC/1.1\r\n")
    assert b"Content-Length: 0\r\n\r\n\r\n\r\n" in found[None]


def records(n, per):
    return [(i // per, i, f"r{i}", 10 + i % 7, hashlib.md5(str(i).encode()).hexdigest()) for i in range(n)]


def test_audit_names_every_damage(spark):
    a = records(700, 70)
    b = [list(r) for r in a]
    b[3][4] = "spoilt"  # other bytes
    b[150][3] += 1  # longer: other bytes, and all behind it move
    b[150][4] = "longer"
    b[699][4] = "spoilt"
    extra = [5, 10_000, "new", 3, "n"]
    lost = 400
    b = [tuple(r) for i, r in enumerate(b) if i != lost] + [tuple(extra)]
    found = {r.record_id: r.status for r in fixity.audit(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()}
    want = {f"r{i}": "intact" for i in range(700)} | {"new": "extra", "r3": "altered", "r150": "altered", "r699": "altered", "r400": "missing"}
    want |= {f"r{i}": "moved" for i in [*range(151, 210), *range(401, 420)]}
    assert found == want


def test_descent_looks_below_differing_nodes_only(spark):
    a = records(512, 64)
    b = [list(r) for r in a]
    b[77][4] = "spoilt"
    both = [fixity.leaves(fixity.manifest(spark.createDataFrame(x, SCHEMA))).withColumn("side", F.lit(s)) for s, x in (("a", a), ("b", b))]
    levels = fixity.tree(both[0].unionByName(both[1]))
    assert [df.filter("side = 'a'").count() for _, df in levels] == [512, 64, 8, 1]
    assert [tuple(r) for r in fixity.differing(levels).collect()] == [(1, 13)]


def test_repeated_records_equal_replicas_and_empty_tables(spark):
    rows = [(0, i, "same", 5, "d") for i in range(9)] + [(1, 9, None, 5, "d")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = fixity.audit(frame, frame).collect()
    assert len(found) == 10 and {r.status for r in found} == {"intact"}
    less = fixity.audit(frame, frame.filter("at <> 4")).collect()
    assert sorted(r.status for r in less) == ["intact"] * 9 + ["missing"]
    none = frame.filter(F.lit(False))
    assert fixity.audit(none, none).count() == 0
    assert {r.status for r in fixity.audit(frame, none).collect()} == {"missing"}


def test_places_number_all_rows_in_order(spark):
    frame = spark.createDataFrame([(i % 10,) for i in range(500)] + [(None,)] * 500, "k long").repartition(7)
    found = sorted((r.at, r.k) for r in fixity.numbered(frame, ["k"]).collect())
    assert [a for a, _ in found] == list(range(1000)) and [k for _, k in found] == [None] * 500 + sorted(i % 10 for i in range(500))
    assert fixity.numbered(frame.filter(F.lit(False)), ["k"]).count() == 0
