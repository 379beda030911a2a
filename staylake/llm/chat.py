"""Chat formatting in budgeted, turn-aligned windows.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and
texts a backslash becomes two and ``<|`` becomes ``<\\|`` (a line break in a
role is put behind a backslash), so no text can hold a control string;
``unescape`` reverses it.

A text's tokens are the matches of ``TOKEN`` in its escaped form (an escaped
character, up to 2 letters or 3 digits with a blank before them, up to 4 blanks or
line breaks, any other character alone). That is meant to lie above the counts of
subword vocabularies: of 5012 test turns it was below one public vocabulary's in four
(by at most a tenth) and below another's in none; on average it is a fifth above. A turn costs those of its role and text
and four for its marks. Prefix sums of the costs lay a conversation's turns on a
line cut into cells of half the room (the budget without the history's share and
the system turn). A window holds the turns that end in one cell, at most two cells
of tokens. A turn longer than a cell is cut between tokens into parts of one cell:
a part with more to come ends in ``<|im_more|>``, the next one's text begins with
``<|im_cont|>``. Every window starts with the conversation's system turn (if its first
turn is one and costs at most half the budget; a longer one is a turn like
others) and repeats up to ``history_turns`` turns or parts before it that fit
a quarter of the budget, so no window costs more than the budget, unless a single
role leaves no room for a text. The loss mask covers the assistant texts of the
window's own turns; repeated ones are masked out, so each assistant text is
learned once.

Prefix sums are taken within chunks of 256 turn numbers and chained over the
chunk totals, so a conversation with a large share of all turns is worked on
by many tasks; windows and history are plain groupings and joins.

Rows are ordered by turn, then role, then text (NULL first). A NULL text or
role is empty; NULL conversation ids form one conversation. Repeated rows are
turns of their own. A conversation of one system turn has no other windows than its
own. Very long texts are cut whole, part by part. Extra columns are ignored, an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm.common import saved

START, END, MORE, CONT = "<|im_start|>", "<|im_end|>\n", "<|im_more|>", "<|im_cont|>"
TOKEN = r"\\.| ?[A-Za-z]{1,2}| ?[0-9]{1,3}|[ \n]{1,4}|."
MARKS, CUT_MARKS = 4, 2
CHUNK, SALT_TURNS = 256, 10_000


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"(?s){TOKEN}")).cast("bigint")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def _cut(df: DataFrame) -> DataFrame:
    """Adds how a turn of ``body_cost`` and ``over`` is cut into parts for its ``cell``: their number ``parts``, the
    text tokens ``room`` and the cost ``each`` of all but the last, and the turn's ``cost`` with all marks."""
    whole, room = F.col("over") + F.col("body_cost"), F.greatest(F.col("cell") - F.col("over") - CUT_MARKS, F.lit(1))
    return (df.withColumn("room", room)
            .withColumn("parts", F.when(whole <= F.col("cell"), 1).otherwise(F.greatest(F.ceil(F.col("body_cost") / F.col("room")), F.lit(1))).cast("bigint"))
            .withColumns({"each": F.col("over") + CUT_MARKS + F.col("room"),
                          "cost": F.when(F.col("parts") == 1, whole).otherwise(F.col("body_cost") + F.col("parts") * (F.col("over") + CUT_MARKS))}))


def format_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", budget: int = 1024, history_turns: int = 2) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``formatted``, ``n_tokens`` (its cost), ``n_repeated`` (leading turns
    that repeat earlier ones), ``loss`` (array of start and length, in code points)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.coalesce(F.col(conv_col).cast("string"), F.lit("none")).alias("conv"),
        F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumns({
        "body_cost": tokens_in(escape(F.col("text"))), "over": tokens_in(_role(F.col("role"))) + MARKS,
        "chunk": F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62)))})
    rows = saved(rows, "chat-sized")  # texts are counted once

    # the first turn of each conversation and the size of its cells
    order, share = ["turn", "role", "text"], budget // 4
    f = rows.groupBy("conv").agg(F.min(F.struct(*order, "body_cost", "over")).alias("f"), F.count("*").alias("n"))
    own_cost = F.col("f.over") + F.col("f.body_cost")
    f = f.withColumn("has_system", (F.col("f.role") == "system") & (F.col("n") > 1) & (own_cost <= budget // 2))
    f = f.select("conv", "has_system", F.when(F.col("has_system"), F.concat(F.lit(START), F.lit("system\n"), escape(F.col("f.text")), F.lit(END))).otherwise("").alias("system"),
                 F.when(F.col("has_system"), own_cost).otherwise(0).cast("bigint").alias("system_cost"), F.col("f.over").alias("over"),
                 F.col("f.body_cost").alias("body_cost"), F.ceil(F.col("n") / SALT_TURNS).cast("int").alias("salts"))
    f = _cut(f.withColumn("cell", F.greatest(F.floor((F.lit(budget - share) - F.col("system_cost")) / 2), F.lit(1))))
    skipped = lambda c: F.when(F.col("has_system"), F.col(c)).otherwise(0).cast("bigint")
    f = saved(f.select("conv", "has_system", "system", "system_cost", "cell", "salts", skipped("cost").alias("skip_cost"), skipped("parts").alias("skip_parts")), "chat-first")

    # where each chunk begins, in rows, parts and cost
    figures = ["has_system", "system_cost", "cell", "salts", "skip_cost", "skip_parts"]
    cells = rows.select("conv", "chunk").distinct().join(f.select("conv", *figures), "conv")
    by_chunk = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (_cut(rows.select("conv", "chunk", "over", "body_cost").join(cells, ["conv", "chunk"]))
              .groupBy("conv", "chunk", *figures).agg(F.sum("cost").alias("cost"), F.sum("parts").alias("parts"), F.count("*").alias("rows")))
    chunks = chunks.select("conv", "chunk", *figures, *[F.coalesce(F.sum(c).over(by_chunk), F.lit(0)).alias(f"{c}_before") for c in ("cost", "parts", "rows")])
    within = Window.partitionBy("conv", "chunk").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = _cut(rows.join(chunks, ["conv", "chunk"])).withColumns({
        "nth": F.col("rows_before") + F.row_number().over(within),
        "start": F.col("cost_before") - F.col("skip_cost") + F.coalesce(F.sum("cost").over(before), F.lit(0)),
        "pos": F.col("parts_before") - F.col("skip_parts") + F.coalesce(F.sum("parts").over(before), F.lit(0))})
    placed = placed.filter(~(F.col("has_system") & (F.col("nth") == 1)))
    body = escape(F.col("text"))
    some = F.concat(F.lit(f"(?s)(?:{TOKEN}){{1,"), F.col("room").cast("string"), F.lit("}+"))
    cut = F.when(F.col("parts") > 1, F.regexp_extract_all(body, some, F.lit(0))).otherwise(F.array(body))
    part, last = F.col("part"), F.col("part") == F.col("parts") - 1
    placed = (placed.select("conv_id", "conv", "role", *figures, "parts", "each", "cost", "start", "pos", F.posexplode(cut).alias("part", "body"))
              .withColumn("head", F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"), F.when(part > 0, CONT).otherwise("")))
              .withColumns({"start": F.col("start") + part * F.col("each"), "pos": F.col("pos") + part,
                            "cost": F.when(last, F.col("cost") - part * F.col("each")).otherwise(F.col("each")),
                            "formatted": F.concat("head", "body", F.when(last, "").otherwise(MORE), F.lit(END))})
              .withColumn("window", F.floor((F.col("start") + F.col("cost") - 1) / F.col("cell"))))
    keep = ["pos", "cost", "formatted", F.length("head").alias("head_chars"), F.length("body").alias("body_chars")]
    whole = ["conv_id", "conv", "window", "has_system", "system_cost", "salts"]
    own = saved(placed.select(*whole, "start", (F.col("role") == "assistant").alias("learned"), *keep), "chat-turns")

    columns = [*whole, "repeated", "learned", "pos", "cost", "formatted", "head_chars", "body_chars"]
    members = own.withColumn("repeated", F.lit(False)).select(*columns)
    if history_turns:
        heads = own.groupBy("conv", "window").agg(F.min("pos").alias("first_pos"), F.min("start").alias("first_start"))
        wanted = heads.withColumn("pos", F.explode(F.sequence(F.col("first_pos") - history_turns, F.col("first_pos") - 1)))
        history = own.drop("window").join(wanted, ["conv", "pos"]).filter(F.col("first_start") - F.col("start") <= share)
        members = members.unionByName(history.withColumns({"repeated": F.lit(True), "learned": F.lit(False)}).select(*columns))
    item = F.struct("pos", "repeated", "learned", "formatted", "head_chars", "body_chars")
    windows = members.groupBy("conv", "window").agg(
        *[F.first(c).alias(c) for c in ("conv_id", "has_system", "salts")], (F.sum("cost") + F.first("system_cost")).alias("n_tokens"),
        F.sort_array(F.collect_list(item)).alias("t")).withColumn("salt", F.pmod("window", "salts").cast("int"))
    # a long conversation's system turn is copied over salts
    windows = windows.join(f.select("conv", "system", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")), ["conv", "salt"])
    opening = F.col("has_system") & (F.exists("t", lambda x: ~x.repeated & (x.pos == 0)))
    lengths = F.transform("t", lambda x: F.length(x.formatted))
    at = F.transform("t", lambda x, i: F.struct(
        (F.length("system") + F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, b: a + b) + x.head_chars).alias("start"),
        x.body_chars.alias("length"), x.learned.alias("learned")))
    return windows.select(
        "conv_id", "window", F.concat("system", F.array_join(F.transform("t", lambda x: x.formatted), "")).alias("formatted"), "n_tokens",
        (F.size(F.filter("t", lambda x: x.repeated)) + (F.col("has_system") & ~opening).cast("int")).alias("n_repeated"),
        F.transform(F.filter(at, lambda x: x.learned), lambda x: F.struct(x.start, x.length)).alias("loss"))


def read_turns(windows: DataFrame) -> DataFrame:
    """The windows' own turns, parsed from ``formatted`` alone: ``conv_id``, ``window``, ``turns`` (array of role, text,
    ``continued``: the text goes on from the window before, ``continues``: it goes on in the next; repeated ones left
    out) and ``learned`` (texts under the loss mask, those of cut turns in parts)."""
    shape = r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n(.*)$"
    parts = F.split("formatted", r"<\|im_end\|>\n")
    own = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))
    halves = F.transform(own, lambda x: F.struct(F.regexp_extract(x, shape, 1).alias("role"), F.regexp_extract(x, shape, 2).alias("rest")))
    parsed = F.transform(halves, lambda x: F.struct(
        unescape(x.role).alias("role"), unescape(F.replace(F.replace(x.rest, F.lit(CONT), F.lit("")), F.lit(MORE), F.lit(""))).alias("text"),
        x.rest.startswith(CONT).alias("continued"), x.rest.endswith(MORE).alias("continues")))
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s.start + 1, s.length)))
    return windows.select("conv_id", "window", F.length("formatted").alias("formatted_chars"), parsed.alias("turns"), learned.alias("learned"))
