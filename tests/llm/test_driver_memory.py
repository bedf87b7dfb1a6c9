"""Tables that grow with the input are never gathered in the driver for a broadcast."""

from warehaus.llm import common, jaccard


def plans_of(monkeypatch, work):
    """The planned joins of every table that ``work()`` writes, and of the one it returns."""
    found = []

    def watched(df, purpose):
        found.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, purpose)

    kept = common.stored
    monkeypatch.setattr(common, "stored", watched)
    monkeypatch.setattr(jaccard, "stored", watched)
    found.append(work()._jdf.queryExecution().executedPlan().toString())
    return [line for plan in found for line in plan.splitlines() if "Join" in line]


def documents(spark):
    text = "concat_ws(' ', transform(sequence(0, 40), i -> concat('w', i + 100 * (id % 20))), if(id % 3 = 0, 'x', 'y'))"
    return spark.range(200).selectExpr("id as doc_id", f"{text} as text")


def test_near_duplicates_broadcast_nothing_but_the_filter(spark, monkeypatch):
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1 << 20
    docs = documents(spark)
    joins = plans_of(monkeypatch, lambda: jaccard.drop_near(docs))
    assert sum("SortMergeJoin" in j for j in joins) > 10
    # the blocks of the filter of the rows that may go: at most 64 MB
    assert all("block#" in j for j in joins if "Broadcast" in j)
    assert jaccard.drop_near(docs).count() == 20


def test_components_broadcast_nothing(spark, monkeypatch):
    edges = spark.range(1, 50).selectExpr("id as u", "id + if(id % 10 = 0, 0, 1) as v")
    joins = plans_of(monkeypatch, lambda: common.components(edges))
    assert joins and not [j for j in joins if "Broadcast" in j]
    assert common.components(edges).select("comp").distinct().count() == 5
