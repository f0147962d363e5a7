from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, values
from ticketloom import schemas
from ticketloom.operators import associations as ops
from ticketloom.operators import compare, joins, tickets
from ticketloom.plans.associations import analyse_associations, expand_emails
from ticketloom.plans.subjects import compare_subjects


def edges_of(spark, rows):
    """rows: (ticket, association, pos)"""
    return spark.createDataFrame(rows, "ticket_id string, association_id string, pos long")


def tickets_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_histogram_leaves_out_tickets_without_associations(spark):
    e = edges_of(spark, [("1", "a", 0), ("1", "b", 1)])
    counts = ops.association_counts(tickets_of(spark, "1", "2", "3"), e)
    assert values(counts) == [("1", 2)]
    assert values(ops.association_histogram(counts)) == [(2, 1)]


def test_null_ids_count_as_null_associations(spark):
    t = tickets_of(spark, "1", "2", "3")
    e = edges_of(spark, [("1", "a", 0), ("1", None, 1)])
    assert values(ops.null_associations(t, e)) == [(3, 3, 100.0)]
    assert values(ops.tickets_without_association(t, e)) == [("2",), ("3",)]


def test_several_null_edges_push_the_rate_above_the_share(spark):
    t = tickets_of(spark, "1", "2")
    e = edges_of(spark, [("1", None, 0), ("1", None, 1), ("1", None, 2)])
    assert values(ops.null_associations(t, e)) == [(4, 2, 200.0)]


def test_counts_equal_those_of_the_merge_with_repeated_tickets(spark):
    t = tickets_of(spark, "1", "1", "2", "3", None)
    e = edges_of(spark, [("1", "a", 0), ("1", None, 1), ("2", "b", 0), ("9", "c", 0), (None, "d", 0)])
    merged = ops.merge_associations(t, e)
    by_merge = (
        merged.where(F.col("ticket_id").isNotNull())
        .groupBy("ticket_id")
        .agg(F.count("association_id").alias("n_associations"))
    )
    assert values(ops.association_counts(t, e)) == values(by_merge)
    null_rows = merged.where(F.col("association_id").isNull()).count()
    assert ops.null_associations(t, e).first().null_rows == null_rows
    assert values(merged) == values(t.join(e, t.id == e.ticket_id, "left"))


def test_empty_edges_keep_every_ticket_once(spark):
    t = tickets_of(spark, "1", "2", "3")
    e = spark.createDataFrame([], schemas.ASSOCIATION)
    merged = ops.merge_associations(t, e)
    assert merged.columns == ["id", *schemas.ASSOCIATION.fieldNames()]
    assert values(merged, "id") == [("1",), ("2",), ("3",)]
    assert values(ops.null_associations(t, e)) == [(3, 3, 100.0)]


def test_percentage_over_no_rows_is_null(spark):
    t = tickets_of(spark, "1").limit(0)
    e = edges_of(spark, [("1", "a", 0)])
    assert values(ops.null_associations(t, e)) == [(0, 0, None)]
    empty = spark.createDataFrame([], schemas.COMPARISON)
    assert values(compare.subject_match_rate(empty)) == [(0, 0, None)]


def test_merge_refuses_ambiguous_columns(spark):
    t = tickets_of(spark, "1").withColumn("pos", F.lit(1))
    with pytest.raises(ValueError, match="pos"):
        ops.merge_associations(t, edges_of(spark, [("1", "a", 0)]))


def test_first_association_follows_response_order(spark):
    e = edges_of(spark, [("1", "z", 0), ("1", "a", 1), ("2", "d", 5), ("2", "c", 5)])
    assert values(ops.first_association(e)) == [("1", "z", 0), ("2", "c", 5)]


def test_topk_keeps_at_most_k(spark):
    e = edges_of(spark, [("1", f"a{i}", i) for i in range(5)] + [("2", "b", 0)])
    kept = values(ops.associations_topk(e, 2), "ticket_id", "association_id", "rank")
    assert kept == [("1", "a0", 1), ("1", "a1", 2), ("2", "b", 1)]


def emails_of(spark, rows):
    return spark.createDataFrame(
        [(i, s, f"text {i}", f"<p>{i}</p>", "t") for i, s in rows], schemas.EMAIL
    )


def test_compare_uses_the_first_email_and_mismatches_on_null(spark):
    t = spark.createDataFrame(
        [("1", "A"), ("2", None), ("3", "C"), ("4", "D"), ("5", "E")], "id string, subject string"
    )
    e = edges_of(spark, [("1", "x", 0), ("1", "y", 1), ("2", "n", 0), ("3", "y", 0), ("4", "gone", 0)])
    m = emails_of(spark, [("x", "A"), ("y", "B"), ("n", None)])
    for few in (False, True):
        comparison = compare.first_email_compare(t, e, m, few_tickets=few)
        assert values(comparison, "ticket_id", "ticket_subject", "email_subject") == [
            ("1", "A", "A"),
            ("2", None, None),
            ("3", "C", "B"),
        ]
        assert values(compare.subject_match_rate(comparison)) == [(3, 1, 33.33)]
        matches = compare.subject_matches(comparison).count()
        assert matches + compare.subject_mismatches(comparison).count() == comparison.count()


def test_compare_looks_a_repeated_ticket_up_once(spark):
    t = spark.createDataFrame([("1", "B"), ("1", "A")], "id string, subject string")
    e = edges_of(spark, [("1", "x", 0)])
    comparison = compare.first_email_compare(t, e, emails_of(spark, [("x", "A")]))
    assert values(comparison, "ticket_id", "ticket_subject") == [("1", "A")]


def test_sampled_comparison_equals_the_comparison_of_the_sample(spark):
    t = spark.range(500).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3).cast("string").alias("subject")
    )
    e = spark.range(2000).select(
        (F.col("id") % 500).cast("string").alias("ticket_id"),
        (F.col("id") % 7).cast("string").alias("association_id"),
        (F.col("id") / 500).cast("long").alias("pos"),
    )
    m = emails_of(spark, [(str(i), str(i % 3)) for i in range(7)])
    sample = tickets.sample_tickets(t, 100, "s")
    report = compare_subjects(t, e, m, 100, "s")
    expected = compare.first_email_compare(t, e, m).join(
        sample.select(F.col("id").alias("ticket_id")), "ticket_id", "left_semi"
    )
    assert report.comparison.count() == 100
    assert values(report.comparison) == values(expected)
    assert report.matches.count() + report.mismatches.count() == 100


def test_sample_is_repeatable_and_never_raises(spark):
    t = tickets_of(spark, *[str(i) for i in range(1000)])
    one, again = values(tickets.sample_tickets(t, 100, "a")), values(tickets.sample_tickets(t, 100, "a"))
    assert one == again and len(set(one)) == 100
    assert one != values(tickets.sample_tickets(t, 100, "b"))
    assert tickets.sample_tickets(t.limit(3), 100).count() == 3


def test_expansion_splits_edges_into_resolved_and_unresolved(spark):
    t = tickets_of(spark, "1", "2", "3")
    e = edges_of(
        spark, [("1", "x", 0), ("1", "y", 1), ("2", "gone", 0), ("2", None, 1), ("4", "x", 0)]
    )
    out = expand_emails(t, e, emails_of(spark, [("x", "X"), ("y", "Y")]))
    assert values(out.emails, "ticket_id", "association_id", "subject") == [
        ("1", "x", "X"),
        ("1", "y", "Y"),
    ]
    assert values(out.unresolved) == [("2", "gone"), ("2", None)]
    assert values(out.per_ticket) == [("1", 2), ("2", 0), ("3", 0)]


def test_copies_of_an_email_do_not_multiply_its_tickets(spark):
    e = edges_of(spark, [("1", "x", 0), ("2", "x", 0), ("2", "x", 1)])
    landed = emails_of(spark, [("x", "B"), ("x", "A"), ("x", "A"), ("y", None), ("y", "Y")])
    emails = ops.one_per_id(landed)
    assert values(emails, "id", "hs_email_subject") == [("x", "A"), ("y", None)]
    assert emails.columns == landed.columns
    for found in (ops.ticket_emails(e, landed), ops.ticket_emails(e, emails, unique_emails=True)):
        assert values(found, "ticket_id", "subject") == [("1", "A"), ("2", "A"), ("2", "A")]
    t = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, subject string")
    for few in (False, True):
        comparison = compare.first_email_compare(t, e, landed, few_tickets=few)
        assert values(comparison, "ticket_id", "email_subject") == [("1", "A"), ("2", "A")]
        single = compare.first_email_compare(t, e, emails, few_tickets=few, unique_emails=True)
        assert values(single) == values(comparison)


def test_rejected_tickets_do_not_count_as_unassociated(spark):
    t = tickets_of(spark, "1", "2", "3")
    e = edges_of(spark, [("1", "a", 0)])
    rejected = spark.createDataFrame([("3", "timeout")], "ticket_id string, status string")
    assert values(analyse_associations(t, e, rejected).nulls) == [(1, 2, 50.0)]


def mart_and_raw(spark):
    day = dt.datetime(2024, 5, 31, 12)
    mart = spark.createDataFrame(
        [
            ("1", day, "in window", "Support", "EMAIL"),
            ("2", day - dt.timedelta(days=30), "first day", "Support", "EMAIL"),
            ("3", day - dt.timedelta(days=31), "too old", "Support", "EMAIL"),
            ("4", day, "other pipeline", "Sales", "EMAIL"),
            ("5", day, "other source", "Support", "FORM"),
            ("6", None, "no date", "Support", "EMAIL"),
        ],
        schemas.TICKET_MART,
    )
    raw = spark.createDataFrame([("1", "body"), ("9", "none")], "id string, property_content string")
    return mart, raw


def test_support_tickets(spark):
    mart, raw = mart_and_raw(spark)
    out = tickets.support_tickets(mart, raw, "2024-05-31")
    assert out.columns == schemas.SUPPORT_TICKET.fieldNames()
    assert values(out, "ticket_id", "ticket_content") == [("1", "body"), ("2", None)]


def test_current_date_is_the_default_window_end(spark):
    mart, raw = mart_and_raw(spark)
    now = mart.limit(1).withColumn("create_date", F.current_timestamp())
    assert tickets.support_tickets(now, raw).count() == 1
    assert tickets.support_tickets(mart, raw).count() == 0


def test_recent_tickets_window_and_cutoff_agree(spark):
    raw = spark.createDataFrame(
        [(str(i), dt.datetime(2024, 5, 31) - dt.timedelta(days=i)) for i in range(60)],
        "id string, property_createdate timestamp",
    )
    rolling = tickets.recent_tickets(raw, "2024-05-31")
    fixed = tickets.recent_tickets(raw, cutoff="2024-05-01")
    assert [r.id for r in rolling.collect()] == [str(i) for i in range(31)]
    assert rolling.collect() == fixed.collect()


def hot_edges(spark, n=400_000):
    """A third of the rows belong to ticket 7; the rest are spread over 20,000 tickets."""
    i = F.col("id")
    hot = F.when(i % 3 == 0, F.lit(7)).otherwise(i % 20_000)
    return spark.range(0, n, 1, 16).select(
        hot.cast("string").alias("ticket_id"),
        F.sha2(i.cast("string"), 256).alias("association_id"),
        i.alias("pos"),
    )


def test_hot_ticket_is_dealt_over_the_tasks_of_the_merge(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    t = spark.range(0, 25_000).select(F.col("id").cast("string").alias("id"))
    e = hot_edges(spark)

    def largest_task(df):
        per_task = df.groupBy(F.spark_partition_id().alias("task")).count()
        return per_task.agg(F.max("count")).first()[0]

    merged = ops.merge_associations(t, e, rows_per_share=1000)
    plain = t.join(e, t.id == e.ticket_id, "left")
    assert largest_task(plain) > 133_000
    assert largest_task(merged) < 25_000
    assert merged.count() == plain.count()
    assert values(digest(merged)) == values(digest(plain))
    assert "ReusedExchange" in final_plan(merged)


def digest(df):
    """An order-independent fingerprint of a table."""
    return df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))


def test_tickets_without_id_are_kept_where_they_lie(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    even = F.col("id") % 2 == 0
    t = spark.range(0, 8_000, 1, 8).select(F.when(even, F.col("id").cast("string")).alias("id"), F.col("id").alias("n"))
    e = spark.createDataFrame([("2", "x"), ("2", "y"), (None, "z")], "ticket_id string, association_id string")
    merged = ops.merge_associations(t, e)
    plain = t.join(e, t.id == e.ticket_id, "left")
    assert merged.count() == plain.count() == 8_001
    assert values(digest(merged)) == values(digest(plain))
    tasks = merged.where("id IS NULL").groupBy(F.spark_partition_id().alias("task")).count()
    assert tasks.agg(F.max("count")).first()[0] <= 500


def test_copies_of_one_edge_are_dealt_out_too(spark):
    t = tickets_of(spark, "7", "8", "9", None)
    copies = spark.range(0, 5000, 1, 16).select(
        F.lit("7").alias("ticket_id"), F.lit("a").alias("association_id"), F.lit(0).alias("pos")
    )
    e = copies.union(spark.createDataFrame([("8", "b", 0), ("1", "c", 0), (None, "d", 0)], e_schema))
    merged = ops.merge_associations(t, e, rows_per_share=100)
    counted = values(merged.groupBy("id", "association_id").count())
    assert counted == sorted([("7", "a", 5000), ("8", "b", 1), ("9", None, 1), (None, None, 1)], key=repr)


e_schema = "ticket_id string, association_id string, pos int"


def test_repeated_hot_tickets_multiply_like_any_join(spark):
    t = tickets_of(spark, "7", "7", "8")
    e = edges_of(spark, [("7", str(i), i) for i in range(50)])
    merged = ops.merge_associations(t, e, rows_per_share=10)
    assert values(merged) == values(t.join(e, t.id == e.ticket_id, "left"))


def test_hot_keys_are_listed_largest_first_and_bounded_by_the_partitions(spark, conf, monkeypatch):
    rows = [(k, "x", 0) for k, n in (("a", 5), ("b", 30), ("c", 21), ("d", 25)) for _ in range(n)]
    e = edges_of(spark, rows)
    assert values(joins.hot_keys(e, "ticket_id", 10)) == [("b", 3), ("c", 3), ("d", 3)]
    conf(spark__sql__shuffle__partitions="1")
    monkeypatch.setattr(joins, "HOT_PER_PARTITION", 2)
    assert values(joins.hot_keys(e, "ticket_id", 10)) == [("b", 3), ("d", 3)]
    t = tickets_of(spark, "a", "b", "c", "d", "e")
    merged = ops.merge_associations(t, e, rows_per_share=10)
    assert values(merged) == values(t.join(e, t.id == e.ticket_id, "left"))


def shared_email_edges(spark):
    """Edges of which a third lead to e-mail 7."""
    return hot_edges(spark).select(
        F.col("association_id").alias("ticket_id"), F.col("ticket_id").alias("association_id"), "pos"
    )


def test_hot_email_is_joined_where_its_edges_lie(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    e = shared_email_edges(spark)
    copies = spark.range(0, 30_000).select(
        (F.col("id") % 15_000).cast("string").alias("id"),
        *[F.lit("x").alias(c) for c in schemas.EMAIL.fieldNames()[1:]],
    )
    expanded = ops.ticket_emails(e, copies, rows_per_share=10_000)
    expected = e.where(F.col("association_id").cast("int") < 15_000)
    per_task = expanded.groupBy(F.spark_partition_id().alias("task")).count()
    assert per_task.agg(F.max("count")).first()[0] < 25_000
    assert values(digest(expanded.select("ticket_id", "association_id"))) == values(
        digest(expected.select("ticket_id", "association_id"))
    )
    missing = ops.unresolved_emails(e, copies, rows_per_share=10_000)
    assert missing.count() + expanded.count() == 400_000
    # the e-mails' bodies are shuffled once, for combining copies
    shuffles = [
        line for line in final_plan(expanded).splitlines() if "hashpartitioning(__email_id" in line
    ]
    assert ["ReusedExchange" in line for line in shuffles] == [False, True]


@pytest.mark.parametrize("rows_per_share", [2, 1000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_many_to_one_joins_mean_the_same_with_and_without_hot_keys(spark, how, rows_per_share):
    rows = [("7", i) for i in range(5)] + [("8", i) for i in range(4)] + [("1", 0), ("2", 0), (None, 0)]
    many = spark.createDataFrame(rows, "k string, v int")
    one = spark.createDataFrame([("7", "a"), ("1", "b"), ("9", "c"), (None, "d")], "id string, w string")
    out = joins.join_many_to_one(many, one, "k", "id", how, rows_per_share)
    expected = many.join(one, many.k == one.id, how)
    assert out.columns == expected.columns
    assert values(out) == values(expected)


def test_hot_ticket_is_combined_before_the_shuffle(spark):
    e = hot_edges(spark)
    first = ops.first_association(e).where("ticket_id = '7'").first()
    assert first.pos == 0
    topk = ops.associations_topk(e, 2)
    assert "WindowGroupLimit" in final_plan(topk)
    assert topk.where("ticket_id = '7'").count() == 2
    plan = final_plan(ops.first_association(e))
    assert "partial_min" in plan
