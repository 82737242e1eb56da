"""Preference formatting of conversations, with DataFrame functions only.

Method: the turns of the chosen and of the rejected conversation of a pair are compared; their longest common
prefix is rendered once as the prompt, and what follows in either becomes a completion of segments with a
train flag: the words (and the end mark) of the trained role are trained on, headers and other turns are masked.

Defined results: a turn is (role, text), null in either counts as empty; rows without a pair id belong to no
pair and are left out; a row that is repeated counts once, turns with one number stand in the order of role
and text; a pair with one side missing has an empty completion there and no prompt; equal sides have all in
the prompt and two empty completions; an empty table gives an empty result. The marks `<|` and `|>` inside a
text are written `< |` and `| >`, so a text can't open or close a turn. All turns of one pair are rendered into
one row, which is what the format asks for; many pairs with equal turns share nothing, so they don't meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.operators.ordering import number_values

START, END = "<|im_start|>", "<|im_end|>\n"


def _turns(rows: DataFrame, pair: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    safe = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |")), F.lit("|>"), F.lit("| >"))
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), safe.alias("text"))
    listed = rows.where(F.col(pair).isNotNull()).groupBy(F.col(pair).alias("pair")).agg(F.array_sort(F.collect_set(one)).alias("t"))
    bare = lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))
    return listed.select("pair", F.transform("t", bare).alias(name))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END))), "")


def _segments(turns: Column, trained: str) -> Column:
    def of(t: Column) -> Column:
        head = F.struct(F.concat(F.lit(START), t["role"], F.lit("\n")).alias("text"), F.lit(False).alias("train"))
        body = F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == trained).alias("train"))
        return F.array(head, body)

    return F.flatten(F.transform(turns, of))


def preference_examples(
    chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", trained: str = "assistant",
) -> DataFrame:
    """pair id, n_prompt (turns), prompt, chosen and rejected (arrays of segments (text, train))."""
    both = _turns(chosen, pair, turn, role, text, "c").join(_turns(rejected, pair, turn, role, text, "r"), "pair", "full_outer")
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = both.select("pair", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    # the first place where the sides differ; arrays_zip fills the shorter side with null
    differ = F.array_position(F.transform(F.arrays_zip("c", "r"), lambda z: z["c"].eqNullSafe(z["r"])), F.lit(False))
    both = both.withColumn("n", F.when(differ > 0, differ - 1).otherwise(F.size("c")).cast("int"))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return both.select(
        F.col("pair").alias(pair), F.col("n").cast("long").alias("n_prompt"), _render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _segments(rest("c"), trained).alias("chosen"), _segments(rest("r"), trained).alias("rejected"),
    )


def flat(segments: str) -> tuple[Column, Column]:
    """The text of a completion, and its mask: lengths in characters, those that are not trained on negative."""
    joined = F.array_join(F.transform(segments, lambda s: s["text"]), "")
    mask = F.transform(segments, lambda s: F.when(s["train"], F.length(s["text"])).otherwise(-F.length(s["text"])).cast("string"))
    return joined, F.array_join(mask, ",")


def with_other_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """Rejected conversations of a table without preferences: each with its last reply (turn of the trained role)
    exchanged for that of its neighbour (ids 2k and 2k + 1), or dropped if the neighbour has none.

    Ids that are no whole numbers are numbered first, by `number_values`; their neighbours follow from that number. Rows without
    id stay as they are, and so does a conversation without a reply. Last replies of one turn number: the greatest
    text is handed over, all of them are exchanged. All columns are returned, whatever their names."""
    # the row travels inside a struct, so its columns may have any names
    row = F.struct(*[F.col(f"`{c}`") for c in turns.columns])
    rows = turns.select(row.alias("row"), F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{text}`").alias("text"), (F.col(f"`{role}`") == trained).alias("said"))
    if turns.schema[conv].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        rows = rows.withColumn("number", F.col("conv").cast("long"))
    else:
        rows = rows.join(number_values(rows, "conv", "number"), "conv", "left").withColumn("number", F.col("number").cast("long"))
    last = rows.where("said AND number IS NOT NULL").groupBy("number").agg(F.max("turn").alias("last"), F.max_by("text", F.struct("turn", "text")).alias("reply"))
    other = last.select(F.col("number").bitwiseXOR(F.lit(1)).alias("number"), F.col("reply").alias("other"), F.lit(True).alias("there"))
    marked = rows.join(last.drop("reply"), "number", "left").join(other, "number", "left")
    final = F.coalesce(F.col("said") & (F.col("turn") == F.col("last")), F.lit(False))
    changed = F.when(final, F.col("other")).otherwise(F.col("text"))
    kept = marked.where(~final | F.col("there"))
    return kept.select(*[changed.alias(c) if c == text else F.col("row")[c].alias(c) for c in turns.columns])
