import __spark_entry__ as entry
from tallyhall.llm import registry


def test_every_operator_and_the_pipeline_are_registered():
    names = [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert [int(n[2:].split("_")[0]) for n in names if n != "pipeline"] == list(range(1, 14))
    assert "pipeline" in names and set(registry.QUERIES) == set(names) - {"pipeline"}
    assert set(entry.oracle_sql()) & set(names) == {"op3_winnowing", "op12_seekable_fim", "op13_drift_tightened_kmeans"}
