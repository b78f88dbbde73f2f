from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from fixtures import channel, record
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.plans import daily
from wattledger.plans.chain import DayChain
from wattledger.schema import ESS_ENERGY, RECORD_SETS, SYSTEMS
from wattledger.sources import sinks
from wattledger.sources.uploads import prune_uploads, read_uploads, write_uploads

SCHEMA = T.StructType([*RECORD_SETS.fields, T.StructField("processed_at", T.LongType())])
DAYS, START = 4, 19_000 * 86_400
FIRST = date(1970, 1, 1) + timedelta(days=19_000)
KNOWN = [(h, f"s-{h}", "t", True, "Z", None) for h in "ab"]
OUTPUTS = ("energy", "metrics", "quality")


def _uploads(seed=3):
    """Uploads around each midnight, none on the third day; some records are too old or too new."""
    rng = random.Random(seed)
    rows = []
    for day in (0, 1, 3):
        for second in [*range(0, 4_000, 100), *range(82_400, 86_400, 100)]:
            at, host = START + day * 86_400 + second, rng.choice("aabx")
            times = [at - rng.choice([0] * 8 + [600, 8 * 86_400, -4_000]) for _ in range(rng.choice([1, 1, 2]))]
            seq = len(rows)
            rows.append((seq, "s", [record(t, channel(host, seq * 10, rng.choice([5, 10**6]))) for t in times], at))
    return rows


def _ess():
    return [
        (f"s-{h}", t, *((1.0, 9.0) if (t // 300) % 3 else (9.0, 1.0)))
        for h in "ab"
        for t in range(START - 86_400, START + DAYS * 86_400, 300)
    ]


def _lines(df):
    return sorted(map(str, df.collect()))


def test_days_in_a_chain_equal_one_run_and_go_on_where_they_stopped(spark, tmp_path):
    table, broken = str(tmp_path / "uploads"), [True]
    df = spark.createDataFrame(_uploads(), SCHEMA)
    write_uploads(df, table)
    spark.createDataFrame(KNOWN, SYSTEMS).write.parquet(str(tmp_path / "systems"))
    ess = spark.createDataFrame(_ess(), ESS_ENERGY).withColumn(
        "day", F.date_from_unix_date((F.col("start_ts") / 86_400).cast("int"))
    )
    ess.write.partitionBy("day").parquet(str(tmp_path / "ess"))

    def quality(df, path, mode):
        if path.endswith("=1") and broken:
            broken.clear()
            raise RuntimeError("interrupted")
        sinks.write_table(df, path, mode)

    chain = DayChain(
        str(tmp_path / "out"),
        systems=lambda s: s.read.parquet(str(tmp_path / "systems")),
        ess=lambda s: s.read.parquet(str(tmp_path / "ess")),
        outputs=OUTPUTS,
        ess_date_column="day",
        writers={"quality": quality},
    )
    uploads, last = read_uploads(spark, table), FIRST + timedelta(days=DAYS - 1)
    with pytest.raises(RuntimeError, match="interrupted"):
        chain.run(uploads, FIRST, last)
    assert chain.done(spark) == [FIRST]
    assert chain.run(uploads, FIRST, last) == [FIRST + timedelta(days=d) for d in (1, 2, 3)]
    assert chain.run(uploads, FIRST, last) == []
    with pytest.raises(ValueError, match="starts on"):
        chain.run(uploads, FIRST + timedelta(days=1), last)

    whole = daily.run(
        df, spark.createDataFrame(KNOWN, SYSTEMS), spark.createDataFrame(_ess(), ESS_ENERGY), F.col("processed_at")
    )
    for name in OUTPUTS:
        want = getattr(whole, name)
        got = spark.read.parquet(str(tmp_path / "out" / name)).select(want.columns)
        assert _lines(got) == _lines(want) and want.count(), name


def test_a_run_reads_only_uploads_that_its_clock_can_accept(spark, tmp_path):
    table, now = str(tmp_path / "uploads"), START + 8 * 86_400
    rows = _uploads() + [(999, "s", [record(float("nan"), channel("a", 1, 1))], START), (998, "s", [], START)]
    write_uploads(spark.createDataFrame(rows, SCHEMA), table)
    kept = prune_uploads(read_uploads(spark, table), now)
    assert kept.columns == SCHEMA.names
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PushedFilters") :]
    assert "last_ts" in filters and "first_ts" in filters

    def meets(times):
        return not times or any(t != t for t in times) or (
            max(times) >= now - 7 * 86_400 and min(times) <= now + 1_800
        )

    want = [seq for seq, _, records, _ in rows if meets([r[0] for r in records])]
    assert sorted(r.arrival_seq for r in kept.collect()) == sorted(want) and len(want) < len(rows)

    tables = spark.createDataFrame(KNOWN, SYSTEMS), spark.createDataFrame(_ess(), ESS_ENERGY)
    got = daily.run(kept, *tables, now).energy
    whole = daily.run(spark.createDataFrame(rows, SCHEMA), *tables, now).energy
    assert _lines(got) == _lines(whole) and whole.count()


def test_a_day_reads_its_own_folder(spark, tmp_path):
    table = str(tmp_path / "uploads")
    write_uploads(spark.createDataFrame(_uploads(), SCHEMA), table)
    day = read_uploads(spark, table).where(F.col("upload_date") == F.lit(FIRST))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(upload_date" in plan
    assert day.count() == 80


def test_uploads_without_a_day_are_refused(spark, tmp_path):
    table = str(tmp_path / "uploads")
    write_uploads(spark.createDataFrame([(0, "s", [], None)], SCHEMA), table)
    chain = DayChain(str(tmp_path / "out"), systems=None, ess=None)
    with pytest.raises(ValueError, match="belong to no day"):
        chain.run(read_uploads(spark, table), FIRST, FIRST)
