"""Queries reach the rows of their whole tables."""

from oracle import DATA

import tidemark.plans.pipelines  # noqa: F401
import tidemark.plans.records  # noqa: F401
import tidemark.plans.resolution  # noqa: F401
from tidemark.plans import views as V
from tidemark.registry import QUERIES


def test_whole_tables(spark):
    run = lambda name: QUERIES[name](spark, DATA).collect()
    med = V.med(spark, DATA).select("medicine_id", "name", "strength", "size").collect()
    assert {r.medicine_id for r in run("j9_prefix_lookup")} == {r.medicine_id for r in med}
    changes = {(r.medicine_id, r.platform) for r in run("st1_st4_stream_changes")}
    assert changes == {tuple(r) for r in V.listing(spark, DATA).where("sale IS NOT NULL").select("medicine_id", "platform").distinct().collect()}
    assert {r.cand_id for r in run("j10_signature_lookup")} == {r.medicine_id for r in med}
    leaders = {(r.dose, r.leader) for r in run("e19_overlap_groups")}
    assert leaders and {d for d, _ in leaders} <= {r.strength for r in med}
    assert len(run("e13_interlink_fuzzy_key")) > 0 and len(run("e14_interlink_integers")) > 0
