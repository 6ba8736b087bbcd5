"""Chat formatting in budgeted windows.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``; control strings
inside a text are escaped reversibly (``<``, n backslashes, ``|`` gets one more
backslash, so ``<|`` never survives), and line ends in a role are encoded, so
neither can forge a turn.

Windows: token counts per turn are added up along the conversation (prefix
sums); a turn's window follows from the sum before it, so spans are aligned with
turns and need no sequential search. Every window gets the system turn, whatever
its length: its tokens come off the budget of the conversation's windows. A window
repeats up to ``history`` tokens of the turns before it, as far as the budget
allows, and carries a loss mask: the
assistant turns of its own span are targets, repeated ones are masked -- each
target counts once over all windows.

DataFrame expressions only. Turns are ordered by (turn, role, text); prefix sums
run in two levels (chunks of ``CHUNK`` turn numbers, then chunk totals), so that
a conversation of any length is not sorted in one task for them. Null texts are
empty, a null role is the empty role, a null turn comes first; rows with a null
conv_id form one conversation of that id; repeated rows are turns of their own.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 2048
HISTORY = 512
#: System turns up to this length leave the other turns their full share.
SYSTEM = 512
#: Turn numbers per chunk of the two-level prefix sums.
CHUNK = 256
#: What a turn costs besides its role and text.
TURN_TOKENS = 4




def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def token_count(c: Column) -> Column:
    """The estimate that budgets are held against: words and single marks, a long
    word being a token for every six characters, so that no run passes as one."""
    return F.regexp_count(c, F.lit(r"\w{1,6}|[^\w\s]"))


def _turns(df: DataFrame) -> DataFrame:
    """Turns with their prefix sums: p (tokens before), the place sp and tokens st of
    the conversation's first system turn, and w and e (1 for a turn too long to share
    a window; the next turn starts in a later stride anyway)."""
    t = df.select(F.col("conv_id").cast("long").alias("conv_id"),
                  F.col("turn").cast("long").alias("turn"),
                  F.coalesce("role", F.lit("")).alias("role"),
                  F.coalesce("text", F.lit("")).alias("text"))
    t = (t.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
         .withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62))))
         .withColumn("tokens", (token_count(F.col("text")) + token_count(F.col("role"))
                                + TURN_TOKENS).cast("long")))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    upto = Window.partitionBy("conv", "chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    t = t.withColumn("p", F.sum("tokens").over(upto) - F.col("tokens"))
    whole = Window.partitionBy("conv").orderBy("chunk")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    chunks = t.groupBy("conv", "chunk").agg(
        F.sum("tokens").alias("ct"),
        F.min(F.when(F.col("role") == "system", F.struct("p", "tokens"))).alias("cs"))
    chunks = chunks.select("conv", "chunk", "cs",
                           F.coalesce(F.sum("ct").over(before), zero).alias("p0"))
    first = F.first(F.when(F.col("cs").isNotNull(), F.struct(
        (F.col("cs.p") + F.col("p0")).alias("p"), F.col("cs.tokens").alias("tokens"))),
        ignorenulls=True).over(everywhere)
    chunks = chunks.withColumn("s", first).select(
        "conv", "chunk", "p0", F.col("s.p").alias("sp"), F.col("s.tokens").alias("st"))
    t = t.join(chunks, ["conv", "chunk"]).withColumn("p", F.col("p") + F.col("p0"))
    stride = _stride(F.col("st"))
    return t.select("conv", "conv_id", "role", "text", "tokens", "p", "sp", "st",
                    F.floor(F.col("p") / stride).alias("w"),
                    (F.col("tokens") > stride).cast("long").alias("e"))


#: Turns that start within one stride share a window; none of them is longer than
#: a stride, so a span holds at most two strides.
_STRIDE = (BUDGET - HISTORY - SYSTEM) // 2


def _stride(system: Column) -> Column:
    """The stride beside a system turn of so many tokens: two of them are left two
    thirds of the rest. One that fills the budget by itself cannot be helped."""
    return F.when((system > SYSTEM) & (system < BUDGET), F.greatest(
        F.lit(1), F.floor((F.lit(BUDGET) - system) / 3))).otherwise(F.lit(_STRIDE)).cast("long")


def format_windows(df: DataFrame) -> DataFrame:
    """One row per window: conv_id, w and e (its place in the conversation),
    n_tokens, formatted, and parts: array of (kind, p, start, length, body,
    body_length, target) with 1-based code point positions in ``formatted``.

    kind 0 is the retained system turn, 1 repeated history, 2 the window's own
    span. The loss mask is the body of every part with ``target``. A window is above
    the budget only by a single long turn, its own or the system turn, which are
    kept whole; history is repeated in what is left."""
    t = _turns(df).withColumn("head", F.concat(F.lit(START), _escape_role(F.col("role")),
                                               F.lit("\n")))
    # Read four times below.
    t = stage(t.withColumn("body", escape(F.col("text"))), "chat_turns")
    own = t.select("conv", "conv_id", "w", "e", F.lit(2).alias("kind"), "p", "tokens", "role",
                   "head", "body")
    windows = t.groupBy("conv", "conv_id", "w", "e").agg(
        F.min("p").alias("p_first"), F.sum("tokens").alias("span"),
        F.first("sp").alias("sp"), F.first("st").alias("st"))
    retained = F.when(F.col("sp") < F.col("p_first"), F.col("st")).otherwise(0)
    windows = windows.withColumn("room", F.least(
        F.lit(HISTORY), F.lit(BUDGET) - F.col("span") - retained))
    sys_rows = windows.filter("sp < p_first").select(
        "conv", "conv_id", "w", "e", F.lit(0).alias("kind"), F.col("sp").alias("p"))
    # History: turns that start within the room (HISTORY tokens at most) before the
    # window; buckets of that width make it an equality join.
    bucket = F.floor((F.col("p_first") - 1) / HISTORY)
    past = (windows.filter("p_first > 0 and room > 0")
            .withColumn("bucket", F.explode(F.array(bucket, bucket - 1))))
    placed = t.select("conv", F.floor(F.col("p") / HISTORY).alias("bucket"), "p")
    history = past.join(placed, ["conv", "bucket"]).filter(
        (F.col("p") < F.col("p_first")) & (F.col("p") >= F.col("p_first") - F.col("room"))
        & ~F.col("p").eqNullSafe(F.col("sp"))).select(
        "conv", "conv_id", "w", "e", F.lit(1).alias("kind"), "p")
    repeated = sys_rows.unionByName(history).join(
        t.select("conv", "p", "tokens", "role", "head", "body"), ["conv", "p"])
    rows = own.unionByName(repeated.select(own.columns))
    tail = F.lit(END + "\n")
    part = F.struct("kind", "p", "tokens", (F.col("role") == "assistant").alias("answers"),
                    "head", "body")
    win = rows.groupBy("conv", "conv_id", "w", "e").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.sum("tokens").alias("n_tokens"))
    text = F.array_join(F.transform("parts", lambda x: F.concat(x["head"], x["body"], tail)), "")
    length = lambda x: F.length(x["head"]) + F.length(x["body"]) + len(END) + 1
    laid = F.aggregate(
        "parts", F.struct(F.lit(1).alias("at"), F.array().cast(
            "array<struct<kind:int,p:bigint,start:int,length:int,body:int,body_length:int,"
            "target:boolean>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + length(x)).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                x["kind"].alias("kind"), x["p"].alias("p"), acc["at"].alias("start"),
                length(x).alias("length"), (acc["at"] + F.length(x["head"])).alias("body"),
                F.length(x["body"]).alias("body_length"),
                (x["answers"] & (x["kind"] == 2)).alias("target")))).alias("out")),
        lambda acc: acc["out"])
    return win.select("conv_id", "w", "e", "n_tokens", text.alias("formatted"),
                      laid.alias("parts"))


def read_back(windows: DataFrame) -> DataFrame:
    """The turns as the formatted windows hold them, each once: conv_id, p (its
    order), role, text, target."""
    p = windows.select("conv_id", "formatted", F.explode("parts").alias("x")).filter("x.kind = 2")
    turn = F.substr("formatted", F.col("x.start"), F.col("x.length"))
    p = p.select("conv_id", F.col("x.p").alias("p"), F.col("x.target").alias("target"),
                 turn.alias("turn"))
    inner = F.substr("turn", F.lit(len(START) + 1), F.length("turn") - len(START + END) - 1)
    p = p.withColumn("inner", inner).withColumn("cut", F.instr("inner", "\n"))
    return p.select("conv_id", "p", "target",
                    _unescape_role(F.substr("inner", F.lit(1), F.col("cut") - 1)).alias("role"),
                    unescape(F.substr("inner", F.col("cut") + 1, F.length("inner"))).alias("text"))


def digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted windows alone. The hash of a
    conversation needs its text in one row; nothing else is gathered."""
    turns = read_back(windows).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("p", "role", "text", "target"))).alias("t"))
    said = F.array_join(F.transform("t", lambda x: F.concat(
        x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("t", lambda x: x["target"]), lambda x: x["text"]), "")
    size = windows.groupBy("conv_id").agg(
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"))
    out = turns.select("conv_id", F.size("t").cast("long").alias("n_turns"),
                       F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"))
    return out.join(size, out["conv_id"].eqNullSafe(size["conv_id"])).select(
        out["conv_id"], "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
        "formatted_chars", "n_windows")
