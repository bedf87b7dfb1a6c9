from pyspark.sql import functions as F

from tests.test_summary import B, tables
from warehaus import session
from warehaus.operators import monthly as M
from warehaus.operators import summary as S

KEY = ["start_of_the_month_date", "dw_customer_id"]


def plan(df, stage="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


def test_merge_reads_either_side_once(spark):
    daily = S.daily_customer_summary(*tables(spark), B).localCheckpoint()
    delta = M.monthly_customer_delta(daily, B)
    merged = plan(M.merge_additive(M.stamp_new(delta, B).localCheckpoint(), delta, KEY, M.MONTHLY_CUSTOMER_COLUMNS, B))
    assert merged.count("Join ") == 1 and merged.count("Aggregate [") == 2  # the two levels of one delta
    assert plan(delta, "sparkPlan").count("Exchange") <= 1 and plan(delta, "executedPlan").count("Exchange hashpartitioning") == 1


def test_merge_with_partly_null_keys_and_measures(spark):
    types = dict(M.MONTHLY_CUSTOMER_COLUMNS)

    def rows(*keys):
        df = spark.createDataFrame(keys, "m string, id bigint, n bigint")
        return df.select(*[(F.to_date("m") if c == KEY[0] else F.col("id") if c == KEY[1] else F.col("n")).cast(t).alias(c)
                           for c, t in types.items()])

    stored = M.stamp_new(rows(("1998-06-01", 1, 5), ("1998-06-01", 2, None), ("1998-06-01", None, 7), ("1998-05-01", 3, 1)), B)
    later = type(B).of(8, "1998-06-02", "1998-06-03 00:00:00")
    delta = rows(("1998-06-01", 1, 2), ("1998-06-01", 2, 4), ("1998-06-01", None, 9), (None, 3, 6))
    got = sorted(((str(r[0]), r[1], r.order_count, r.etl_batch_no, r.dw_create_timestamp == r.dw_update_timestamp)
                  for r in M.merge_additive(stored, delta, KEY, M.MONTHLY_CUSTOMER_COLUMNS, later).collect()), key=str)
    assert got == sorted([("1998-06-01", 1, 7, 8, False), ("1998-06-01", 2, None, 8, False), ("1998-06-01", None, 7, 7, True),
                          ("1998-05-01", 3, 1, 7, True), ("1998-06-01", None, 9, 8, True), ("None", 3, 6, 8, True)], key=str)


def test_money_is_summed_in_cents_without_a_filter_per_line(spark):
    o, od, p, c, pay = tables(spark)
    for df in (S.customer_orders_block(o, od, p, B), S.product_orders_block(o, od, p, B)):
        text = plan(df)
        assert "lambdafunction" not in text and "decimal(38,2)" not in text.lower()


def test_initial_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "a.parquet").write_bytes(b"x" * 10_000)
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(session.INITIAL_PARTITIONS)
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        paths = [str(tmp_path / "a.parquet"), str(tmp_path / "missing.parquet")]
        assert session.partitions_for(spark, paths) == base and spark.conf.get(session.INITIAL_PARTITIONS, None) is None
        monkeypatch.setattr(session, "PARTITION_BYTES", 20)
        assert session.partitions_for(spark, paths) == 500 == int(spark.conf.get(session.INITIAL_PARTITIONS))
        monkeypatch.setattr(session, "PARTITION_BYTES", 200)
        assert session.partitions_for(spark, paths) == 500  # a larger setting stays
    finally:
        spark.conf.set(session.INITIAL_PARTITIONS, before) if before else spark.conf.unset(session.INITIAL_PARTITIONS)


def test_stage_load_tests_a_field_for_blanks_once(spark):
    from warehaus.schemas import DATE, TS, _schema
    from warehaus.sources.landing import CORRUPT
    from warehaus.sources.stage_load import parse_landing
    raw = spark.createDataFrame([("20050610", "\u000106/10/2005", None), ("", "10-JUN-05 1:45 PM", None)], f"d string, t string, {CORRUPT} string")
    df = parse_landing(raw, _schema(("d", DATE), ("t", TS)))
    assert plan(df).count("ltrim(") == 2
    rows = df.collect()
    assert str(rows[0].d) == "2005-06-10" and rows[0].t is None and rows[0].reject_reason == "t"
    assert rows[1].d is None and rows[1].t.hour == 13 and not rows[1].is_rejected


def test_joins_hash_a_bounded_side_instead_of_sorting_both(spark):
    names = (session.LOCAL_MAPS, "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    a, b = (spark.range(1000).select((F.col("id") % 997).alias(k), F.col("id").alias(f"v{k}")) for k in "ab")
    try:
        spark.conf.unset(session.LOCAL_MAPS)
        spark.conf.set(names[1], "-1")
        session.prefer_local_maps(spark)
        j = a.join(b, F.col("a") == F.col("b"), "left")
        assert len(j.collect()) == 1006
        assert "ShuffledHashJoin" in plan(j, "executedPlan").split("Initial Plan")[0]
        spark.conf.set(session.LOCAL_MAPS, "0")
        session.prefer_local_maps(spark)  # a setting of the session stays
        assert spark.conf.get(session.LOCAL_MAPS) == "0"
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_only_lines_of_chosen_orders_meet_the_products(spark):
    o, od, p, c, pay = tables(spark)
    for df in (S.customer_orders_block(o, od, p, B), S.daily_product_summary(o, od, p, B)):
        joins = [line for line in plan(df).splitlines() if "Join " in line]
        assert ["LeftOuter" in j or "dw_product_id" in j for j in joins] == [True, False]  # the outer join first


def test_month_text_equals_the_formatter(spark):
    from warehaus.plans.storage import UNDATED, month_of
    rows = spark.sql("select timestamp_ntz'0000-03-01 00:00:00' t union all select timestamp_ntz'0007-01-31 23:59:59' union all "
                     "select timestamp_ntz'2005-11-01 00:00:00' union all select timestamp_ntz'9999-12-31 23:59:59.999999' "
                     "union all select timestamp_ntz'12005-01-01 00:00:00' union all select cast(null as timestamp_ntz)").localCheckpoint()
    got = rows.select(month_of("t").alias("m"), F.coalesce(F.date_format("t", "yyyy-MM"), F.lit(UNDATED)).alias("w")).collect()
    assert all(r.m == r.w for r in got) and len({r.m for r in got}) == 6
    assert "lpad" in plan(rows.select(month_of("t").alias("m")))


def test_clean_text_passes_ascii_through(spark):
    from warehaus.functions.text import clean_text
    df = spark.sql("select 'plain \\n text' c union all select '' union all select cast(null as string) union all select cast(x'61FF62' as string)")
    assert sorted(r[0] for r in df.select(clean_text(F.col("c")).alias("c")).collect()) == ["", "", "ab", "plain \n text"]


def test_customer_day_is_one_aggregate_over_all_blocks(spark):
    o, od, p, c, pay = tables(spark)
    assert plan(S.daily_customer_summary(o, od, p, c, pay, B)).count("Aggregate [") == 2  # counted ids, then the day
    none = pay.withColumn("amount", F.lit(None).cast("decimal(18,2)"))
    rows = {(str(r.summary_date), r.dw_customer_id): r for r in S.daily_customer_summary(o, od, p, c, none, B).collect()}
    assert rows["1998-06-02", 100].payment_amount == 0  # other blocks add 0
    alone = S.daily_customer_summary(o.limit(0), od, p, c.limit(0), none, B).collect()
    assert [(r.payment_amount, r.payment_apd, r.order_count, r.order_cost_amount) for r in alone] == [(None, 1, 0, 0)]


def test_both_daily_summaries_read_the_same_lines(spark):
    o, od, p, c, pay = tables(spark)
    o = o.withColumn("status", F.when(F.col("dw_order_id") == 4, " cancelled ").otherwise(F.col("status")))  # for products only
    lines = S.daily_lines(o, od, p, B).localCheckpoint()
    for with_lines, without in ((S.daily_customer_summary(o, od, p, c, pay, B, lines), S.daily_customer_summary(o, od, p, c, pay, B)),
                                (S.daily_product_summary(o, od, p, B, lines), S.daily_product_summary(o, od, p, B))):
        assert "Join " not in plan(with_lines)
        assert sorted(with_lines.collect(), key=str) == sorted(without.collect(), key=str) != []


def test_monthly_money_is_summed_in_cents(spark):
    daily = S.daily_customer_summary(*tables(spark), B).localCheckpoint()
    products = S.daily_product_summary(*tables(spark)[:3], B).localCheckpoint()
    for delta, ids in ((M.monthly_customer_delta(daily, B), 3), (M.monthly_product_delta(products, B), 2)):
        text = plan(delta)
        assert "as decimal(20,0)" in text and len(delta.collect()) <= ids
    assert sum(r.order_cost_amount for r in M.monthly_customer_delta(daily, B).collect()) == 11
