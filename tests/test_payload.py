"""Events as bytes against the library of protocol buffers, with a schema that is made from the table of numbers."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirelens.operators import payload as p
from wirelens.plans import from_frames
from wirelens.sources.tables import stored

pool = pytest.importorskip("google.protobuf.descriptor_pool")
from google.protobuf import descriptor_pb2, message_factory  # noqa: E402

D = descriptor_pb2.FieldDescriptorProto
KINDS = {T.StringType: D.TYPE_STRING, T.BinaryType: D.TYPE_BYTES, T.BooleanType: D.TYPE_BOOL, T.IntegerType: D.TYPE_INT64, T.LongType: D.TYPE_INT64}


def schema(kind, numbers):
    """A message class for a Spark type; named values are numbers."""
    file = descriptor_pb2.FileDescriptorProto(name="t.proto", package="t", syntax="proto3")

    def message(k, known):
        made = file.message_type.add(name=f"M{len(file.message_type)}")
        for f in k.fields:
            number, inner = known[f.name] if isinstance(known[f.name], tuple) else (known[f.name], {})
            many = isinstance(f.dataType, T.ArrayType)
            one = f.dataType.elementType if many else f.dataType
            field = made.field.add(name=f.name, number=number, label=D.LABEL_REPEATED if many else D.LABEL_OPTIONAL)
            if isinstance(one, T.StructType):
                field.type, field.type_name = D.TYPE_MESSAGE, f".t.{message(one, inner)}"
            else:
                field.type = D.TYPE_INT64 if inner else KINDS[type(one)]
        return made.name

    name = message(kind, numbers)
    files = pool.DescriptorPool()
    files.Add(file)
    return message_factory.GetMessageClass(files.FindMessageTypeByName(f"t.{name}"))


def fill(message, row, kind, numbers):
    for f in kind.fields:
        number_inner = numbers[f.name] if isinstance(numbers[f.name], tuple) else (numbers[f.name], {})
        value, inner = row[f.name], number_inner[1]
        if value is None:
            continue
        if isinstance(f.dataType, T.StructType):
            getattr(message, f.name).SetInParent()
            fill(getattr(message, f.name), value, f.dataType, inner)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            for x in value:
                fill(getattr(message, f.name).add(), x, f.dataType.elementType, inner)
        elif isinstance(f.dataType, T.ArrayType):
            getattr(message, f.name).extend(value)
        else:
            setattr(message, f.name, inner[value] if inner else bytes(value) if isinstance(value, bytearray) else value)
    return message


@pytest.fixture(scope="module")
def events(spark):
    return stored(from_frames.transactions(spark, "/root/testdata/sf0.001").select("event"), "events")


def test_events_of_the_table(spark, events):
    kind = events.schema["event"].dataType
    made = schema(kind, p.EVENT)
    rows = events.select("event", p.encoded("event", kind).alias("payload")).collect()
    assert len(rows) > 500
    for r in rows:
        assert bytes(r.payload) == fill(made(), r.event, kind, p.EVENT).SerializeToString(deterministic=True)


def test_size_cap(spark, events):
    kind = events.schema["event"].dataType
    made = schema(kind, p.EVENT)
    sizes = sorted(r[0] for r in events.select(F.octet_length(p.encoded("event", kind))).collect())
    largest = sizes[len(sizes) // 2]
    out = {r.event_id: r for r in p.entries(events, largest).collect()}
    seen = {True: 0, False: 0, None: 0}
    for r in events.collect():
        whole = fill(made(), r.event, kind, p.EVENT)
        long = whole.ByteSize() > largest
        if long:
            for side in ("query", "response"):
                if whole.dns_transaction.HasField(side):
                    getattr(whole.dns_transaction, side).raw_dns_payload = b""
                    getattr(whole.dns_transaction, side).raw_payload_truncated = True
        found = out.get(r.event.envelope.event_id)
        assert (found is not None) == (whole.ByteSize() <= largest)
        seen[found and found.truncated] += 1
        if found:
            assert found.truncated == long and bytes(found.payload) == whole.SerializeToString(deterministic=True)
    assert min(seen.values()) > 0


LONGS = T.ArrayType(T.LongType())
ONE = T.StructType().add("a", "integer").add("t", "string")
SEVERAL = T.ArrayType(T.StructType().add("a", "integer").add("t", "string").add("n", LONGS))
ODD = T.StructType().add("i", "integer").add("l", "long").add("b", "boolean").add("s", "string").add("x", "binary").add("e", "string").add("many", LONGS).add("one", ONE).add("rows", SEVERAL)
NUMBERS = {"i": 9, "l": 1, "b": 16, "s": 2, "x": 3000, "e": (4, {"A": 1, "B": 300}), "many": 5, "one": (6, {"a": 1, "t": 2}), "rows": (7, {"a": 3, "t": 1, "n": 2})}


def odd_rows(n):
    rng = random.Random(5)
    longs = [0, 1, -1, 127, 128, 16383, 16384, 2**31, 2**62, 2**63 - 1, -(2**63)]
    one = lambda f: rng.choice([None, f()])
    text = lambda: rng.choice(["", "a", "\u00e9\u4e2d\U0001f600", "x" * 300, "\x00"])
    small = lambda: rng.choice([0, 5, -7, 2**31 - 1])
    many = lambda: [rng.choice(longs) for _ in range(rng.choice([0, 1, 5]))]
    return [
        (one(small), one(lambda: rng.choice(longs)), one(lambda: rng.random() < 0.5), one(text), one(lambda: bytearray(rng.randbytes(rng.choice([0, 1, 200])))), rng.choice([None, "A", "B"]),
         one(many), one(lambda: (one(small), one(text))), one(lambda: [(one(small), one(text), one(many)) for _ in range(rng.choice([0, 1, 3]))]))
        for _ in range(n)
    ]


def test_any_values_both_ways(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(odd_rows(200))] + [(-1, None)], T.StructType().add("id", "long").add("v", ODD))
    made = schema(ODD, NUMBERS)
    coded = df.withColumn("raw", p.encoded("v", ODD, NUMBERS))
    rows = p.decode(coded, "raw", ODD, "back", NUMBERS).collect()
    assert len(rows) == 201
    for r in rows:
        if r.v is None:
            assert r.raw is None and r.back is None
            continue
        assert bytes(r.raw) == fill(made(), r.v, ODD, NUMBERS).SerializeToString(deterministic=True)
        assert fill(made(), r.back, ODD, NUMBERS) == fill(made(), r.v, ODD, NUMBERS)
        assert r.back.i == (r.v.i or 0) and r.back.s == (r.v.s or "") and r.back.many == (r.v.many or []) and (r.back.one is None) == (r.v.one is None)


def test_other_writers_and_broken_bytes(spark):
    made = schema(ODD, NUMBERS)
    a, b = made(i=3, s="first", many=[1, 300]), made(s="last", l=-5)
    cases = {
        "again": b.SerializeToString() + a.SerializeToString() + b.SerializeToString(),
        "unpacked": b"\x28\x07\x2a\x02\x08\xac\x28\xac\x02"[:2] + b"\x28\xac\x02",
        "unknown": b"\xa0\x06\x01\xa9\x06" + b"12345678" + b"\xad\x06" + b"1234" + b"\xb2\x06\x02hi" + a.SerializeToString(),
        "kind": b"\x12\x01a" + b"\x4a\x01z",
        "empty": b"",
        "cut": a.SerializeToString()[:-1],
        "group": a.SerializeToString() + b"\x0b",
        "endless": b"\x08" + b"\xff" * 30,
        "longer": b"\x12\x7fab",
        "zero": b"\x00\x01",
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "name string, raw binary")
    rows = {r.name: r for r in p.decode(df.withColumn("at", p.walked("raw")["at"]), "raw", ODD, "v", NUMBERS).collect()}
    fine = {k for k, r in rows.items() if r.at == len(cases[k])}
    assert fine == {"again", "unpacked", "unknown", "kind", "empty"}
    assert (rows["again"].v.s, rows["again"].v.i, rows["again"].v.l, rows["again"].v.many) == ("last", 3, -5, [1, 300])
    assert rows["unpacked"].v.many == [7, 300]
    assert (rows["unknown"].v.i, rows["unknown"].v.s) == (3, "first")
    assert (rows["kind"].v.s, rows["kind"].v.i) == ("a", 0)
    assert (rows["empty"].v.s, rows["empty"].v.one, rows["empty"].v.rows) == ("", None, [])
    assert rows["group"].v.i == 3 and rows["longer"].v.s == ""


def test_entries_that_cannot_be_opened(spark, events):
    kind = events.schema["event"].dataType
    good = p.entries(events.limit(4)).withColumn("n", F.row_number().over(Window.orderBy("event_id")))
    bad = good.withColumns(
        {
            "encoding": F.when(F.col("n") == 1, "json").otherwise(F.col("encoding")),
            "schema": F.when(F.col("n") == 2, "x").otherwise(F.col("schema")),
            "payload": F.when(F.col("n") == 3, F.expr("substring(payload, 1, 20)")).otherwise(F.col("payload")),
        }
    )
    rows = {r.n: r for r in p.opened(bad, kind).collect()}
    assert [rows[n].error for n in (1, 2, 3, 4)] == ["encoding", "schema", "bytes", None]
    assert [rows[n].event is None for n in (1, 2, 3, 4)] == [True, True, True, False]
    assert p.opened(p.entries(events.where("false")), kind).count() == 0


def test_entries_are_opened_in_one_pass(spark, events):
    """No fold over bytes, which took milliseconds an event, and one call of Python for each entry."""
    kind = events.schema["event"].dataType
    plan = p.opened(p.entries(events), kind)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and plan.count("ArrowEvalPython") == 2  # the tree and its details
