"""Rows without conversation id: many of them, each a conversation of its own, none gathered with another."""

from pyspark.sql import functions as F

from souk.llm import chat


def test_a_third_of_the_rows_without_conversation_id(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.floor(F.col("id") / 6)).alias("conv_id"),
        (F.col("id") % 6).cast("int").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("said "), (F.col("id") % 9).cast("string")).alias("text"),
        F.col("id").alias("leaf"),
        F.lit("x").alias("row"),
    )
    packed = chat.pack(rows)
    back = chat.read_back(packed).collect()
    lost = [r for r in back if r.conv_id is None]
    assert len(lost) == 300 and all(r.n_turns == 1 for r in lost) and len(back) == 300 + 150
    assert sum(r.n_turns for r in back) == 900
    assert len({r.turns_sha256 for r in lost}) == len({(r.role, r.text) for r in rows.filter("conv_id is null").collect()})
    # Equal lone rows share one node, and no task holds more than one of them at a time.
    nodes = {bytes(n.node): n.conversations for n in packed.nodes.filter("depth = 0").collect()}
    assert sum(nodes.values()) == 450
    assert packed.paths.filter("conv_id is null").groupBy("leaf").count().agg(F.max("count")).first()[0] == 1
