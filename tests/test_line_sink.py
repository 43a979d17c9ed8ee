"""The line sink: what fails and runs again is delivered once, and what is rejected is kept."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wirelens.sources import line_sink


def delivered(path):
    parts = [json.loads(x)["id"] for p in sorted(Path(path).glob("batch=*/part-*")) for x in p.read_text().splitlines()]
    rejected = [(r["reason"], r["payload"]) for p in Path(path).glob("batch=*/rejected-*") for r in map(json.loads, p.read_text().splitlines())]
    return sorted(parts), sorted(rejected, key=str)


def test_delivered_once_though_tasks_fail_and_batches_run_again(spark, tmp_path):
    line_sink.register(spark)
    out, broken = str(tmp_path / "out"), tmp_path / "broken"
    lines = spark.range(900).select(F.to_json(F.struct("id")).alias("line"))
    odd = spark.createDataFrame([(None,), ("",), ("[1]",), ("x{",), ('{"id": "' + "y" * 300 + '"}',)], "line string")
    lines.unionByName(odd).repartition(6).write.parquet(f"{tmp_path}/in")

    def fails(batches):
        for batch in batches:
            yield batch
        if broken.exists():
            from pyspark import TaskContext

            if TaskContext.get().partitionId() == 2:
                raise RuntimeError("lost")

    def run():
        stream = spark.readStream.schema("line string").parquet(f"{tmp_path}/in").mapInArrow(fails, "line string")
        query = stream.writeStream.format(line_sink.NAME).option("mostBytes", 200).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(out)
        query.awaitTermination()

    broken.touch()
    with pytest.raises(Exception, match="lost"):
        run()
    assert not Path(out).exists() or not list(Path(out).glob("batch=*"))
    broken.unlink()
    run()
    want = (list(range(900)), sorted([("empty", None), ("empty", ""), ("no JSON object", "[1]"), ("no JSON object", "x{"), ("too long", '{"id": "' + "y" * 300 + '"}')], key=str))
    assert delivered(out) == want

    # the commit is taken back, as if the query had been lost right after delivery, so the batch runs again
    for p in Path(tmp_path, "state", "commits").iterdir():
        p.unlink()
    run()
    assert delivered(out) == want
    lines.where("id < 3").write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert len(delivered(out)[0]) == 903 and len(list(Path(out).glob("batch=*"))) == 2
    assert not [p for p in Path(out).iterdir() if p.name.startswith("_")]
