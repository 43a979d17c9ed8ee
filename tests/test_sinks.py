import random
import uuid

from wirelens.operators import delivery, project
from wirelens.plans.catalogue import _wide
from wirelens.sources.wire import wire
from wirelens.streaming import sinks

SF = "/root/testdata/sf0.001"


def test_rejected_lines_are_isolated():
    rng = random.Random(2)
    for _ in range(30):
        lines = [f"l{i}" for i in range(rng.randint(0, 40))]
        bad = {x for x in lines if rng.random() < 0.15}
        got, waits, seen = [], [], [0]

        def post(batch):
            seen[0] += 1
            if seen[0] % 5 == 0:
                return rng.choice([None, 429, 503])
            if bad.intersection(batch):
                return 400
            got.extend(batch)
            return 200

        assert list(sinks.deliver(lines, post, waits.append)) == [x for x in lines if x in bad]
        assert sorted(got) == sorted(x for x in lines if x not in bad)
        assert all(1 <= w <= 30 for w in waits)


def test_three_sinks_of_one_stream(spark, tmp_path):
    _wide(spark, SF).write.parquet(f"{tmp_path}/in")
    delivery.entries(wire(spark, SF)).write.parquet(f"{tmp_path}/entries")
    n = spark.read.parquet(f"{tmp_path}/in").count()

    def stream(name):
        return spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).parquet(f"{tmp_path}/{name}")

    for _ in range(2):  # the second time there is nothing left
        for query in (
            sinks.wide_sink(stream("in"), f"{tmp_path}/wide", f"{tmp_path}/c1"),
            sinks.json_sink(stream("in"), f"{tmp_path}/json", f"{tmp_path}/c2"),
            sinks.dead_letter_sink(stream("entries"), f"{tmp_path}/dead", f"{tmp_path}/c3"),
        ):
            query.awaitTermination()
    back = spark.read.parquet(f"{tmp_path}/wide")
    assert back.count() == n and set(project.WIDE) < set(back.columns)
    day = back.where("observed_date = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(observed_date" in day._jdf.queryExecution().toString()
    assert spark.read.text(f"{tmp_path}/json").count() == n
    assert spark.read.parquet(f"{tmp_path}/dead").count() == delivery.dead_letters(delivery.entries(wire(spark, SF))).count()


def test_collector_sink_isolates_rejected_lines(spark, tmp_path):
    lines = [f"line {i}" if i % 40 else f"bad {i}" for i in range(1, 201)]
    spark.createDataFrame([(x,) for x in lines], "line string").repartition(3).write.parquet(f"{tmp_path}/in")
    (tmp_path / "posted").mkdir()
    folder = str(tmp_path)

    def post(batch):
        if any(x.startswith("bad") for x in batch):
            return 400
        with open(f"{folder}/posted/{uuid.uuid4().hex}", "w") as file:
            file.write("\n".join(batch))
        return 200

    stream = spark.readStream.schema("line string").parquet(f"{tmp_path}/in")
    sinks.collector_sink(stream, post, f"{tmp_path}/rejected", f"{tmp_path}/checkpoint").awaitTermination()
    posted = [x for f in (tmp_path / "posted").iterdir() for x in f.read_text().split("\n")]
    assert sorted(posted) == sorted(x for x in lines if not x.startswith("bad"))
    rejected = spark.read.parquet(f"{tmp_path}/rejected").collect()
    assert sorted(r.payload for r in rejected) == sorted(x for x in lines if x.startswith("bad")) and {r.reason for r in rejected} == {"hec_rejected"}
