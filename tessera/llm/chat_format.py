"""Chat formatting after a cumulative-snapshot collapse, in DataFrame operations only.

Chat logs often hold a conversation again and again as it grows. A turn's term is a 128-bit hash of its
position, role and text; the exclusive-or of the terms up to a turn is that prefix's rolling hash. A
conversation whose whole hash and length equal a proper prefix of another is a snapshot: an anti-join
drops it. Of equal conversations the smallest conv_id stays. The maximal ones are rendered turn by turn.

A conversation may hold a large share of all turns, so none is ever gathered: turns are dealt by
(conversation, block of 256 turn numbers), positions and prefix hashes are scanned inside the blocks, and
only one row a block takes part in the scan across blocks. The result has a row a turn; joined in order
of pos, the rendered pieces of a conv_id are the training text.

Defined cases: null role or text counts as empty; a null turn comes first; turns with the same number
are ordered by role, then text, and repeated rows are turns of their own; rows without conv_id belong
to no conversation and are left out; an empty table gives no rows; other columns are ignored. In texts
and roles `<|` becomes `< |`, so that no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

BLOCK = 256
TRAINED_ROLE = "assistant"


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their block and their place in it."""
    t = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).alias("block"),
    )
    return t.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")))


def _before(column: str, fold):
    """fold of column over the conversation's earlier blocks."""
    return fold(column).over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))


def prefix_hashes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prefixes (conv_id, pos from 1, h1, h2, n_turns) and blocks (conv_id, block, base)."""
    turns = _turns(conversations)
    counts = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = materialise(counts.select("conv_id", "block", F.coalesce(_before("n", F.sum), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns")), "chat-blocks")
    placed = turns.join(blocks, ["conv_id", "block"]).withColumn("pos", F.col("base") + F.col("place"))
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = materialise(
        placed.select("conv_id", "block", "pos", "n_turns", *(F.xxhash64(F.lit(seed), "pos", F.length("role"), "role", "text").alias(h) for seed, h in ((1, "h1"), (2, "h2"))))
        .select("conv_id", "block", "pos", "n_turns", *(F.bit_xor(h).over(inside).alias(h) for h in ("h1", "h2"))),
        "chat-prefixes",
    )
    # A block's last prefix holds all its terms.
    whole = local.groupBy("conv_id", "block").agg(F.max_by(F.struct("h1", "h2"), "pos").alias("h")).select("conv_id", "block", F.col("h.h1").alias("b1"), F.col("h.h2").alias("b2"))
    carried = whole.select("conv_id", "block", *(F.coalesce(_before(b, F.bit_xor), F.lit(0)).alias(b) for b in ("b1", "b2")))
    prefixes = local.join(carried, ["conv_id", "block"]).select("conv_id", "pos", "n_turns", F.col("h1").bitwiseXOR(F.col("b1")).alias("h1"), F.col("h2").bitwiseXOR(F.col("b2")).alias("h2"))
    return prefixes, blocks


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies of the conversations that are no proper prefix of another; copies: equal ones."""
    whole = prefixes.where("pos = n_turns").groupBy(F.col("n_turns").alias("pos"), "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    proper = prefixes.where("pos < n_turns").select("pos", "h1", "h2").distinct()
    return whole.join(proper, ["pos", "h1", "h2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "copies")


def render(role, text):
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe(role), F.lit("\n"), safe(text), F.lit("<|im_end|>\n"))


def chat_format(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), n_turns, copies, role, rendered, trained for each turn of the maximal conversations."""
    prefixes, blocks = prefix_hashes(conversations)
    kept = blocks.drop("n_turns").join(materialise(maximal(prefixes), "chat-maximal"), "conv_id")
    return _turns(conversations).join(kept, ["conv_id", "block"]).select(
        "conv_id", (F.col("base") + F.col("place") - 1).alias("pos"), "n_turns", "copies", "role",
        render(F.col("role"), F.col("text")).alias("rendered"), (F.col("role") == TRAINED_ROLE).alias("trained"),
    )


ORACLE_SQL = r"""
WITH r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
f AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS l FROM r GROUP BY 1),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, len(l))) AS k FROM f)),
m AS (SELECT l, min(conv_id) AS conv_id, count(*) AS copies FROM f WHERE l NOT IN (SELECT l FROM p) GROUP BY l)
SELECT r.conv_id, r.pos - 1 AS pos, len(m.l) AS n_turns, m.copies, r.role,
       '<|im_start|>' || replace(r.role, '<|', '< |') || chr(10) || replace(r.text, '<|', '< |') || '<|im_end|>' || chr(10) AS rendered, r.role = 'assistant' AS trained
FROM r JOIN m USING (conv_id)
"""
