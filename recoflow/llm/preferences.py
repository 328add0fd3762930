"""Preference formatting: a shared prompt and two masked completions.

A pair is two conversations, chosen and rejected, as rows (pair_id, turn, role,
text). Their longest common prefix of turns is rendered once, as the prompt;
what follows is rendered as each side's completion. Only assistant turns of a
completion are trained on; everything else is masked. The result has a row per
rendered turn, so no conversation is gathered: a join finds where two sides
differ, an aggregation takes the first such turn. ``assemble`` makes one row
per pair where conversations are known to be short.

Defined results: a null role or text counts as equal to another null and renders
as empty; repeated equal turns count once; turns with one number but different
contents must be the same set on both sides to be common; a null turn comes
first; a pair whose sides are equal is all prompt; rows without pair_id are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import rank_within, read

TURN = ("turn", "role", "text")


def render(role, text):
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, rendered, masked) with part prompt, chosen or rejected."""
    def side(df, name):
        return df.filter("pair_id IS NOT NULL").select("pair_id", *TURN, F.lit(name).alias("side"))

    both = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    turns = both.groupBy("pair_id", *TURN).agg(F.max(F.col("side") == "chosen").alias("c"), F.max(F.col("side") == "rejected").alias("r"))
    number = F.coalesce("turn", F.lit(-(1 << 63)))
    split = turns.filter(~(F.col("c") & F.col("r"))).groupBy("pair_id").agg(F.min(number).alias("first"))
    turns = turns.join(split, "pair_id", "left")
    common = F.col("first").isNull() | (number < F.col("first"))
    parts = F.when(common, F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("c"), F.lit("chosen")), F.when(F.col("r"), F.lit("rejected"))), lambda p: p.isNotNull()))
    return turns.select("pair_id", F.explode(parts).alias("part"), "turn", "role", render(F.col("role"), F.col("text")).alias("rendered"),
                        (common | ~F.coalesce(F.col("role") == "assistant", F.lit(False))).alias("masked"))


def assemble(rows: DataFrame) -> DataFrame:
    """One row per pair: prompt, chosen and rejected strings, and (length, masked) runs of both completions.

    Gathers each pair's turns; for conversations of bounded length only.
    """
    def of(part, field):
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("turn", "role", "rendered", "masked")))), field)

    def text(part):
        return F.array_join(of(part, lambda t: t["rendered"]), "").alias(part)

    def runs(part):
        return of(part, lambda t: F.struct(F.length(t["rendered"]).alias("length"), t["masked"].alias("masked"))).alias(f"{part}_mask")

    return rows.groupBy("pair_id").agg(text("prompt"), text("chosen"), runs("chosen"), text("rejected"), runs("rejected"))


def other_replies(conversations: DataFrame) -> DataFrame:
    """Rejected sides: each conversation with its last assistant turn answered by the next conversation's last reply."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), *TURN)
    last = (turns.filter("role = 'assistant' AND pair_id IS NOT NULL").groupBy("pair_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")).select("pair_id", "last.turn", "last.text"))
    ranked = rank_within(last, [], [F.col("pair_id")], "rank", "replies")
    n = ranked.count()
    following = ranked.select(F.pmod(F.col("rank") - 1, F.lit(max(n, 1))).alias("rank"), F.col("text").alias("reply"))
    swap = ranked.drop("text").join(following, "rank").select("pair_id", "turn", F.lit("assistant").alias("role"), "reply", F.lit(True).alias("swap"))
    return turns.join(swap, ["pair_id", "turn", "role"], "left").select(
        "pair_id", "turn", "role", F.when(F.col("swap"), F.col("reply")).otherwise(F.col("text")).alias("text"))


def op6_preference_pairs(spark, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    return format_pairs(conversations.withColumnRenamed("conv_id", "pair_id"), other_replies(conversations))


OP6_SQL = r"""
WITH last AS (SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'assistant' GROUP BY 1),
 reply AS (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id) - 1 AS k, count(*) OVER () AS n
           FROM conversations JOIN last USING (conv_id, turn) WHERE role = 'assistant'),
 swap AS (SELECT a.conv_id, a.turn, b.text FROM reply a JOIN reply b ON b.k = (a.k + 1) % a.n),
 t AS (SELECT c.conv_id AS pair_id, c.turn, c.role, c.text AS c, coalesce(s.text, c.text) AS r
       FROM conversations c LEFT JOIN swap s ON s.conv_id = c.conv_id AND s.turn = c.turn),
 f AS (SELECT pair_id, min(turn) FILTER (c <> r) AS first FROM t GROUP BY 1),
 p AS (SELECT t.*, first IS NULL OR turn < first AS common FROM t JOIN f USING (pair_id)),
 o AS (SELECT pair_id, CASE WHEN common THEN 'prompt' ELSE 'chosen' END AS part, turn, role, c AS text, common FROM p
       UNION ALL SELECT pair_id, 'rejected', turn, role, r, common FROM p WHERE NOT common)
SELECT pair_id, part, turn, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered,
       common OR role <> 'assistant' AS masked FROM o
"""
