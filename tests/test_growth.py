"""Work that grows with the rows and not with their square, on tables with large groups of copies."""

import datetime
import random
from pathlib import Path

import duckdb
import pytest
from oracle import both, connect

from pyspark.sql import functions as F

import tidemark.plans.pipelines  # noqa: F401
import tidemark.plans.records  # noqa: F401
import tidemark.plans.relational  # noqa: F401
import tidemark.plans.resolution  # noqa: F401
from tidemark.operators import heal, identity, interlink
from tidemark.registry import ORACLES, QUERIES
from tidemark.streaming import prices


def nodes(plan) -> list:
    """All nodes of a physical plan, those of adaptive stages too."""
    kind = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else []
    children = plan.children()
    return [plan, *[n for c in [*inner, *[children.apply(i) for i in range(children.size())]] for n in nodes(c)]]


def most_joined(df) -> int:
    """The most rows that a join of the plan gave when ``df`` was collected."""
    df.collect()
    joins = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]
    return max((n.metrics().apply("numOutputRows").value() for n in joins), default=0)


def before_shuffles(df) -> str:
    """What the plan does with the rows of its inputs before it first deals them out."""
    plans = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    return "\n".join(n.toString() for n in plans if sum("Exchange" in x.nodeName() for x in nodes(n)) == 1)


@pytest.fixture(scope="module")
def crowd(tmp_path_factory):
    """1,200 medicines of two names, 2 sizes and 2 forms, each with 3 listings."""
    path = tmp_path_factory.mktemp("crowd")
    con = connect()
    con.execute(f"COPY (SELECT k AS p_partkey, ['red widget', 'new widget'][k % 2 + 1] AS p_name, 'Brand#' || k % 3 AS p_brand, ['ECONOMY', 'LARGE'][k // 4 % 2 + 1] AS p_type, CAST(7 + k // 2 % 2 AS INTEGER) AS p_size, 900.0 + k AS p_retailprice FROM range(1200) r(k)) TO '{path}/part.parquet'")
    con.execute(f"COPY (SELECT l.* REPLACE (k // 3 AS l_partkey, k AS l_orderkey, k % 11 AS l_suppkey) FROM range(3600) r(k), (SELECT * FROM lineitem LIMIT 1) l) TO '{path}/lineitem.parquet'")
    return str(path)


def same(spark, name, data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got, want = both(spark, con, QUERIES[name], ORACLES[name], data)
    return got == want


@pytest.mark.parametrize(("name", "most"), [("j10_signature_lookup", 1200), ("j4_alternatives", 6 * 600), ("w1_best_listing", 3600), ("e11_clusters", 1200), ("e12_interlink_same_key", 10), ("e13_interlink_fuzzy_key", 100)])
def test_joins_stay_small(spark, crowd, name, most):
    assert most_joined(QUERIES[name](spark, crowd)) <= most
    assert same(spark, name, crowd)


def test_names_are_parsed_once(spark, crowd):
    rows = spark.createDataFrame([(1, "Dolo 650", "")], "id long, name string, salt string")
    for df in (
        identity.guarded_clusters(rows), identity.duplicate_pairs(rows), heal.heal_report(rows, "name", "salt"),
        interlink.fuzzy_key_groups(rows.selectExpr("name", "name AS normalized_name", "name AS dosage", "name AS canonical_key")), interlink.integer_dose_groups(rows.selectExpr("name", "name AS normalized_name", "name AS dosage", "salt")),
    ):
        assert "regexp" not in before_shuffles(df)


def test_a_composition_is_read_once_per_verdict(spark):
    plan = spark.range(1).select(heal.S.heal(F.col("id").cast("string"), F.col("id").cast("string"))["verdict"])._jdf.queryExecution().optimizedPlan().toString()
    one = spark.range(1).select(heal.S.molecule(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") <= 2 * one.count("regexp_extract")


def test_states_of_a_stream_lie_together(spark, tmp_path):
    """Three rounds of files with late rows, equal stamps and missing prices against a walk in Python; few rows of state."""
    rng, known, want = random.Random(7), {}, []
    schema = "medicine_id long, platform string, scraped_at timestamp, seq long, sale double"
    states = []
    for turn in range(3):
        rows = [(rng.randrange(200), rng.choice(["a", "b"]), datetime.datetime(2024, 1, 1) + datetime.timedelta(days=rng.randrange(6) + 2 * turn), rng.randrange(10**6), rng.choice([1.0, 2.0, None])) for _ in range(2000)]
        for m, p, at, seq, sale in sorted(rows, key=lambda r: r[2:4]):
            had = known.get((m, p))
            if had and (at, seq) <= had[:2]:
                continue
            old = had[2] if had else None
            if old is None or (sale is not None and sale != old):
                want.append((m, p, at, sale, old, seq))
            known[m, p] = (at, seq, sale)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = prices.monotone(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert max(states) <= 200 // prices.NEIGHBOURS + 1
