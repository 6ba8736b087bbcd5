"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one bit per failed rule; a *policy* is just a mask of the bits that reject,
so policies can be versioned, compared and ablated without touching the texts
again (bitwise aggregation over the ledger).

Built from DataFrame expressions only; one projection, no shuffle, rows stay
independent (a hot source or a group of copies changes nothing).

Words are runs of characters other than U+0020 and U+0009..U+000D. A null or
empty text has no words: it fails ``few_words`` and is rejected. Repeated rows
give repeated ledger rows. Extra columns of any name are ignored by
:func:`ledger` and passed through by :func:`apply_policy`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let

WINDOW = 8

#: Bit position of each rule, in a fixed order: stored ledgers depend on it.
RULES = ("few_words", "repeated_words", "symbols", "duplicate_lines", "upper_case",
         "word_length")
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; all comparisons are on integers."""

    min_words: int = 20
    max_repeat_pct: int = 30       # words inside repeated 8-word windows, % of words
    max_symbol_pct: int = 40       # symbols per 100 words
    max_dup_line_pct: int = 50     # repeated lines, % of lines that hold a word
    max_upper_pct: int = 40        # A-Z per 100 word characters
    min_word_chars: int = 2        # mean characters of a word
    max_word_chars: int = 20


def _mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


#: Versioned policies: the bits that reject a document.
POLICIES = {
    "base": _mask("few_words", "repeated_words"),
    "v1": _mask("few_words", "repeated_words", "symbols", "duplicate_lines"),
    "v2": _mask(*RULES),
}
DEFAULT_POLICY = "v2"


def _repeat_words(words: Column) -> Column:
    """Words lying in a window of 8 words whose content occurs twice or more.

    Windows are compared by a 64-bit hash of their words. Documents without
    any repeated window (nearly all) stop at the distinct count; the others
    sort their (hash, position) pairs and add up the union of the windows."""

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: let(
            F.sort_array(F.transform(
                F.filter(s, lambda e, i: (F.get(s, i - 1)["h"].eqNullSafe(e["h"]))
                         | (F.get(s, i + 1)["h"].eqNullSafe(e["h"]))),
                lambda e: e["i"])),
            lambda pos: F.aggregate(
                F.transform(pos, lambda p, i: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(pos, i + 1) - p, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda a, x: a + x)))

    def folded(h: Column, k: int) -> Column:
        """Hashes of windows twice as long: each with the one k words on."""
        return F.zip_with(F.slice(h, F.lit(1), F.size(h) - k),
                          F.slice(h, F.lit(k + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

    no = F.lit(0).cast("long")
    return F.when(F.size(words) <= WINDOW, no).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda h1:
            let(folded(h1, 1), lambda h2: let(folded(h2, 2), lambda h4:
                let(folded(h4, 4), lambda h8: F.when(
                    F.size(F.array_distinct(h8)) == F.size(h8), no).otherwise(covered(h8)))))))


def _measure(text: Column) -> Column:
    """All measurements of one text as a struct (each taken once)."""

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
                        .alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    core = F.btrim(text, F.lit("\x20\t\n\x0b\f\r"))
    words = F.when(core == "", F.array().cast("array<string>")).otherwise(
        F.split(core, r"[\x20\x09-\x0D]+"))
    by_words = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars")))
    return F.struct(
        by_words.alias("w"), let(lines, of_lines).alias("l"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")
        .alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long")
        .alias("n_upper"))


def _ledger_struct(text: Column, limits: Limits) -> Column:
    def with_bits(m: Column) -> Column:
        n, chars = m["w"]["n_words"], m["w"]["word_chars"]
        failed = {
            "few_words": n < limits.min_words,
            "repeated_words": m["w"]["n_repeat_words"] * 100 > n * limits.max_repeat_pct,
            "symbols": m["n_symbols"] * 100 > n * limits.max_symbol_pct,
            "duplicate_lines": m["l"]["n_dup_lines"] * 100
            > m["l"]["n_lines"] * limits.max_dup_line_pct,
            "upper_case": m["n_upper"] * 100 > chars * limits.max_upper_pct,
            "word_length": (chars < n * limits.min_word_chars)
            | (chars > n * limits.max_word_chars),
        }
        bits = F.lit(0).cast("long")
        for name in RULES:
            bits = bits + F.when(failed[name], F.lit(BIT[name])).otherwise(F.lit(0)).cast("long")
        return F.struct(n.alias("n_words"), chars.alias("word_chars"),
                        m["n_symbols"].alias("n_symbols"),
                        m["l"]["n_dup_lines"].alias("n_dup_lines"),
                        m["w"]["n_repeat_words"].alias("n_repeat_words"),
                        m["l"]["n_lines"].alias("n_lines"), m["n_upper"].alias("n_upper"),
                        bits.alias("failed_bits"))

    return let(_measure(F.coalesce(text, F.lit(""))), with_bits)


def ledger(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           limits: Limits = Limits()) -> DataFrame:
    """One row per document: the id, every measurement and ``failed_bits``."""
    led = df.select(F.col(id_col), _ledger_struct(F.col(text_col), limits).alias("_m"))
    return led.select(id_col, "_m.*")


def rejected(bits: Column, policy: str | int = DEFAULT_POLICY) -> Column:
    """True where a rule of the policy (a version name or a mask) failed."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return bits.bitwiseAND(F.lit(mask).cast("long")) != 0


def apply_policy(df: DataFrame, policy: str | int = DEFAULT_POLICY, text_col: str = "text",
                 limits: Limits = Limits()) -> DataFrame:
    """The rows of ``df`` that pass the policy, all columns unchanged."""
    m = fresh(df, "ledger")
    led = df.withColumn(m, _ledger_struct(F.col(text_col), limits)["failed_bits"])
    return led.filter(~rejected(F.col(m), policy)).drop(m)


def ablation(led: DataFrame, policy: str | int = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents that fail it (``n_failed``), documents
    that only it rejects (``n_sole``) and documents kept if it were switched off
    (``n_kept_without``).

    The ledger is first counted by bit pattern (at most 2**rules rows)."""
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = (led.select(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("b"))
                .groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for r in RULES if BIT[r] & mask])
    each = patterns.select("b", "n", F.explode(rules).alias("r")).select("b", "n", "r.*")
    n_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(
        n_if(F.col("b").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        n_if(F.col("b") == F.col("bit")).alias("n_sole"),
        n_if((F.col("b") == 0) | (F.col("b") == F.col("bit"))).alias("n_kept_without"))
