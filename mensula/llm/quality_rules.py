"""Quality rules as a ledger of failure bits, with versioned policies read off the ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose
bit `k` is set when rule `k` failed; the same bit always means the same rule. A policy is a
version, a name and the rules that count. Applying one is a bitwise test of the ledger, and the
ablation of a policy is an aggregation over the masked bits, so neither reads a text again.

All of it is built-in functions within the row: no shuffle, no Python. Texts of any length are
measured whole; work grows with `n log n` of the words of one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """`bit` is fixed for good; `fails` is SQL over the measurements."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 3 * n_words"),
    Rule(3, "long_words", "word_chars > 12 * n_words"),
    Rule(4, "symbols", "10 * n_symbols > n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(6, "many_repeated_words", "100 * n_repeat_words > 30 * n_words"),
)
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """The rules of one version; a document is kept when none of them failed."""

    version: int
    name: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in self.rules)


POLICIES = (
    Policy(1, "base", BASE_RULES),
    Policy(2, "shape", (*BASE_RULES, "short_words", "long_words", "symbols")),
    Policy(3, "strict", (*BASE_RULES, "short_words", "long_words", "symbols", "repeated_lines", "many_repeated_words")),
)
CURRENT = POLICIES[1]


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column) -> Column:
    """Words inside `WINDOW`-word windows that occur at least twice, the first one included."""

    def windows(w: Column, of) -> Column:
        firsts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
        return F.transform(firsts, lambda x, i: of(x, *(F.get(w, i + k) for k in range(1, WINDOW))))

    def within(w: Column) -> Column:
        # Different hashes prove different windows; only texts with equal hashes compare the words themselves.
        some_equal = let(windows(w, F.xxhash64), lambda h: F.size(F.array_distinct(h)) < F.size(h))
        texts = windows(w, lambda *x: F.concat_ws(" ", *x))
        placed = F.sort_array(F.transform(texts, lambda s, i: F.struct(s.alias("s"), i.alias("i"))))
        return F.when(some_equal, let(placed, repeated)).otherwise(F.lit(0))

    def repeated(placed: Column) -> Column:
        # Equal windows stand next to each other; a window repeats when a neighbour is equal.
        starts = F.filter(
            placed,
            lambda x, k: x["s"].eqNullSafe(F.get(placed, k - 1)["s"]) | x["s"].eqNullSafe(F.get(placed, k + 1)["s"]),
        )
        reach = F.transform(starts, lambda x: F.array(*(x["i"] + k for k in range(WINDOW))))
        return F.size(F.array_distinct(F.flatten(reach)))

    return let(words, within)


def measure(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns and the measurements of each whole text; NULL and empty texts measure 0."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    split = df.select(*keep, body.alias("_body"), words_of(F.col(text)).alias("_words"), lines.alias("_lines"))
    return split.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count_of(F.col("_body"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        let(F.col("_lines"), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
    )


def ledger(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measurements and `fail_bits` of each document.

    One row per input row; repeated and NULL ids give a row each. NULL and empty texts fail the
    rule on few words and no other. Other columns of `df` do not matter, whatever their names.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES]
    return measure(df, text, keep).withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def passes(policy: Policy, bits: str = "fail_bits") -> Column:
    """Whether the ledger row passes the policy."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policies(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """The ledger with one boolean `kept_v<version>` per policy."""
    return rows.select("*", *(passes(p).alias(f"kept_v{p.version}") for p in policies))


def ablation(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone (kept if the rule went), and all documents.

    The ledger is first counted by its masked bits, which leaves at most 2^rules rows.
    """
    by_bits = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    chosen = F.array(*(
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
        for r in RULES if r.name in policy.rules
    ))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        by_bits.withColumn("r", F.explode(chosen)).groupBy(F.col("r.rule").alias("rule")).agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
            F.sum("n").alias("documents"),
        )
    )
