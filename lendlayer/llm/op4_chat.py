"""Chat formatting in budgeted windows (DataFrame functions only).

A turn is written as ``<|im_start|>role`` newline ``text<|im_end|>`` newline. Inside roles and
texts backslashes are doubled and ``<|`` becomes ``<\\|`` (a newline in a role ``<\\n``): after
the doubling no single backslash follows ``<``, so the way back is exact and no text can
close or open a turn.

Windows hold whole turns. Prefix sums of the turns' tokens cut a conversation into cells of
equal size (the budget without the leading system turn and the share kept for history);
the turns inside a cell form a window, and a turn that crosses into the next cell forms
one of its own. So a window's place depends on its own prefix sum alone and no task walks a
whole conversation. A turn that is larger than a cell makes a window over budget, and a system turn that leaves
less of the budget than the history share makes all windows so, as they repeat it; such windows are marked. Each window begins with the system turn and with as many of the turns just before
it as the history share holds. The loss covers each assistant text in the one window where
it is not a repetition.

Prefix sums go over blocks of turn numbers first and over the blocks' totals then, so a
conversation with a third of all rows is spread like any other, as long as its turn numbers differ: rows that share
one turn number (or have none) are ordered by one task, which spills.

Null texts and roles count as empty; null turns come first and null conversation ids form
one conversation; ties are ordered by role and text, and repeated rows are turns of their
own; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens a turn's marks count for.
MARKS = 4
#: Turn numbers that share a block of the first prefix sum.
BLOCK = 256
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def _on(*names: str) -> Column:
    """Null-safe equality of columns with their counterparts named ``r_...``."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).eqNullSafe(F.col(f"r_{n}"))
    return out


def number_turns(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """conv_id, ord, role, text, tokens, lead (the leading system turn), start and end (prefix sums
    without the lead), room (tokens of a cell)."""
    plain = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    plain = plain.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long") + MARKS).withColumn("block", F.floor(F.col("turn") / BLOCK))
    inner = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = plain.withColumn("at", F.row_number().over(inner)).withColumn(
        "sum", F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    totals = rows.groupBy("conv_id", "block").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("t"), F.max(F.when(F.col("at") == 1, F.struct("role", "tokens"))).alias("first")
    )
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block"))
    ahead = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select(
        F.col("conv_id").alias("r_conv_id"), F.col("block").alias("r_block"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("t_before"), F.first("first").over(whole).alias("opening"),
    )
    lead_tokens = F.when(F.col("opening.role") == "system", F.col("opening.tokens")).otherwise(0)
    joined = rows.join(totals, _on("conv_id", "block")).select(
        "conv_id", (F.col("at") + F.col("n_before")).alias("ord"), "role", "text", "tokens",
        lead_tokens.alias("lead_tokens"), (F.col("sum") + F.col("t_before")).alias("total"),
    )
    return joined.select(
        "conv_id", "ord", "role", "text", "tokens", "lead_tokens", ((F.col("ord") == 1) & (F.col("lead_tokens") > 0)).alias("lead"),
        (F.col("total") - F.col("tokens") - F.col("lead_tokens")).alias("start"), (F.col("total") - F.col("lead_tokens")).alias("end"),
        F.greatest(budget - history - F.col("lead_tokens"), F.lit(max(history, 1))).alias("room"),
    )


def format_windows(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """conv_id, window, formatted, loss (spans of code points), turns, n_tokens, over_budget."""
    rows = keep(number_turns(turns, budget, history), "numbered")
    cell = F.floor(F.col("start") / F.col("room"))
    crosses = F.floor((F.col("end") - 1) / F.col("room")) > cell
    place = F.when(F.col("lead") | (F.col("start") == 0), F.lit(0).cast("long")).otherwise(2 * cell + crosses.cast("long"))
    rows = rows.withColumn("window", place)
    own = rows.select("conv_id", "window", "ord", "role", "text", "tokens", F.lit(False).alias("repeated"))
    body = rows.filter(~F.col("lead"))
    windows = body.groupBy("conv_id", "window").agg(F.min("start").alias("p0"), F.min("room").alias("room"))
    heads = windows.select(
        F.col("conv_id").alias("r_conv_id"), F.col("window").alias("to"), "p0", F.floor(F.col("p0") / F.col("room")).alias("r_cell")
    )
    # A turn is repeated in the windows that begin after its end and within the history share.
    reach = body.filter(F.col("tokens") <= history).select(
        "conv_id", "ord", "role", "text", "tokens", "start", "end",
        F.explode(F.sequence(F.floor(F.col("end") / F.col("room")), F.floor((F.col("start") + history) / F.col("room")), F.lit(1).cast("long"))).alias("cell"),
    )
    told = reach.join(heads, _on("conv_id", "cell") & (F.col("p0") >= F.col("end")) & (F.col("p0") <= F.col("start") + history))
    parts = own.unionByName(told.select("conv_id", F.col("to").alias("window"), "ord", "role", "text", "tokens", F.lit(True).alias("repeated")))
    leads = rows.filter("lead").select(F.col("conv_id").alias("r_conv_id"), "ord", "role", "text", "tokens")
    again = windows.filter("window > 0").select("conv_id", "window").join(leads, _on("conv_id"))
    parts = parts.unionByName(again.select("conv_id", "window", "ord", "role", "text", "tokens", F.lit(True).alias("repeated")))
    segment = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END))
    target = ~F.col("repeated") & (F.col("role") == "assistant")
    parts = parts.select(
        "conv_id", "window",
        F.struct(
            "ord", "repeated", target.alias("target"), "tokens", segment.alias("segment"),
            F.length(F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))).cast("long").alias("lead"),
            F.length(escape(F.col("text"))).cast("long").alias("size"),
        ).alias("x"),
    )
    # A window's turns are bounded by the budget: each counts for MARKS tokens at least.
    made = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    spans = F.aggregate(
        "xs", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("loss")),
        lambda acc, x: F.struct(
            (acc["at"] + x["lead"] + x["size"] + len(END)).alias("at"),
            F.when(x["target"], F.concat(acc["loss"], F.array(F.struct((acc["at"] + x["lead"]).alias("start"), x["size"].alias("length")))))
            .otherwise(acc["loss"]).alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    tokens = F.aggregate("xs", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])
    return made.select(
        "conv_id", "window", F.array_join(F.transform("xs", lambda x: x["segment"]), "").alias("formatted"), spans.alias("loss"),
        F.transform("xs", lambda x: F.struct(x["ord"].alias("ord"), x["repeated"].alias("repeated"))).alias("turns"),
        tokens.alias("n_tokens"), (tokens > budget).alias("over_budget"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """Turns parsed from the formatted texts, without repetitions: conv_id, ord, role, text."""
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    parsed = windows.select("conv_id", "turns", F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("i", "piece"))
    body = F.substring("piece", F.lit(len(START) + 1), F.length("piece"))
    role = F.substring_index(body, "\n", 1)
    rows = parsed.select(
        "conv_id", F.get("turns", F.col("i")).alias("t"), role.alias("role"), F.substring(body, F.length(role) + 2, F.length(body)).alias("text")
    )
    return rows.filter(~F.col("t.repeated")).select("conv_id", F.col("t.ord").alias("ord"), unescape_role(F.col("role")).alias("role"), unescape(F.col("text")).alias("text"))


def read_targets(windows: DataFrame) -> DataFrame:
    """Texts under the loss mask: conv_id, window, start, text."""
    rows = windows.select("conv_id", "window", "formatted", F.explode("loss").alias("s"))
    return rows.select(
        "conv_id", "window", F.col("s.start").alias("start"),
        unescape(F.substring("formatted", (F.col("s.start") + 1).cast("int"), F.col("s.length").cast("int"))).alias("text"),
    )


def conversation_digest(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its windows.

    A digest runs over a whole conversation's text, so here, and only here, that text comes together.
    """
    turns = read_turns(windows).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct("ord", "role", "text"))).alias("xs")
    )
    turns = turns.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.transform("xs", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
    )
    loss = read_targets(windows).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "start", "text"))).alias("xs"))
    loss = loss.select(F.col("conv_id").alias("r_conv_id"), F.array_join(F.transform("xs", lambda x: x["text"]), "").alias("loss"))
    sizes = windows.groupBy("conv_id").agg(F.sum(F.length("formatted").cast("long")).alias("formatted_chars")).withColumnRenamed("conv_id", "s_conv_id")
    text = F.coalesce(F.col("loss"), F.lit(""))
    return (
        turns.join(loss, _on("conv_id"), "left")
        .join(sizes, F.col("conv_id").eqNullSafe(F.col("s_conv_id")))
        .select("conv_id", "n_turns", "turns_sha256", F.length(text).cast("long").alias("loss_chars"), F.sha2(text.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
    )
