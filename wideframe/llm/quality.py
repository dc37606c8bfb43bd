"""Quality rules (operator 7): a threshold table compiled into one projection.

Each rule names a metric, the accepted range and the smallest document it is
applied to (a ratio of a very short text says little). Metrics are SQL
expressions over the text; ``judge`` compiles the whole table into a single
projection of built-in functions: no user function, no shuffle, one scan.

Defined cases: null text counts as empty (no words; rejected by the base
rule). Extra columns pass through; a column that has the name of an output is
replaced. Repeated rows are judged alike. Equality of word windows is decided
on 64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, words_sql

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Very frequent function words of English, French, German and
#: Spanish (lower case).
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be by this at from or an not "
    "le la les de des du et en un une est que qui dans pour au aux ce il elle pas sur par ne se "
    "der die das und ist nicht ein eine zu den mit von dem des im auf sich es "
    "el los las un una y que se por con para del al lo su como es no"
)


@dataclass(frozen=True)
class Rule:
    name: str
    metric: str           # a metric column or an SQL expression over them
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: Production table. Ratios follow published heuristics for web text (symbol
#: to word ratio, share of words with a letter, repeated lines, stop words).
RULES = (
    Rule("few_words", "n_words", low=20),
    Rule("repeated_windows", "n_repeat_words / greatest(n_words, 1)", high=0.30),
    Rule("word_length", "word_chars / greatest(n_words, 1)", low=2.5, high=12.0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", high=0.10),
    Rule("marks", "n_marks / greatest(word_chars, 1)", high=0.25),
    Rule("letters", "n_letter_words / greatest(n_words, 1)", low=0.60),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", high=0.40),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", low=0.03, min_words=100),
)
BASE = ("few_words", "repeated_windows")


def repeat_words_sql(words: str, width: int = 8) -> str:
    """Words inside windows of ``width`` words that occur at least twice.
    Window hashes are sorted with their positions; positions whose hash equals
    a neighbour's are kept, and the union of their windows is measured."""
    covered = (f"aggregate(sort_array(transform(filter(s, (x, j) -> (j > 0 AND s[j - 1].h = x.h) OR "
               f"(j + 1 < size(s) AND s[j + 1].h = x.h)), x -> x.i)), "
               f"named_struct('n', 0L, 'last', -{width}), "
               f"(a, p) -> named_struct('n', a.n + least({width}, p - a.last), 'last', p), a -> a.n)")
    heavy = let("s", "sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i)))", covered)
    gated = f"IF(size(array_distinct(h)) = size(h), 0L, {heavy})"
    return (f"IF(size({words}) <= {width}, 0L, "
            + let("h", f"transform(sequence(1, size({words}) - {width - 1}), i -> xxhash64(slice({words}, i, {width})))",
                  gated) + ")")


def metrics(text: str, words: str) -> dict[str, str]:
    """Metric name to SQL. ``words`` is a column that holds the word array."""
    t = f"coalesce({text}, '')"
    lines = f"filter(split({t}, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS.split()))
    return {
        "n_words": f"CAST(size({words}) AS BIGINT)",
        "word_chars": rf"CAST(char_length(translate({t}, ' \t\n\u000B\u000C\r', '')) AS BIGINT)",
        "n_symbols": f"CAST(char_length({t}) - char_length(translate({t}, '{SYMBOLS}', '')) AS BIGINT)",
        "n_lines": f"CAST(size({lines}) AS BIGINT)",
        "n_dup_lines": "CAST(" + let("ls", lines, "size(ls) - size(array_distinct(ls))") + " AS BIGINT)",
        "n_repeat_words": repeat_words_sql(words),
        "n_marks": rf"CAST(regexp_count({t}, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\x20\\x09-\\x0D]') AS BIGINT)",
        "n_letter_words": rf"CAST(size(filter({words}, w -> w RLIKE '\\p{{L}}')) AS BIGINT)",
        "n_stop_words": f"CAST(size(filter({words}, w -> lower(w) IN ({stop}))) AS BIGINT)",
    }


def rule_sql(rule: Rule) -> str:
    """SQL that is true where the document fails the rule."""
    bad = " OR ".join([f"({rule.metric}) < {rule.low}D"] * (rule.low is not None)
                      + [f"({rule.metric}) > {rule.high}D"] * (rule.high is not None))
    return f"(n_words >= {rule.min_words} AND ({bad}))"


def judge(docs: DataFrame, text_col: str = "text", rules=RULES, base=BASE) -> DataFrame:
    """``docs`` with the metric columns, ``base_failed``, ``kept`` and
    ``failed_rules`` (names joined by commas, empty when kept)."""
    named = metrics(f"`{text_col}`", "__words")
    keep = [c for c in docs.columns if c not in {*named, "base_failed", "kept", "failed_rules"}]
    # explode(array(x)) yields one row and keeps later filters above it, so
    # words and metrics are computed once
    measured = docs.withColumn("__words", F.explode(F.array(F.expr(words_sql(f"`{text_col}`")))))
    measured = measured.select(*keep, F.explode(F.array(F.struct(*(F.expr(v).alias(k) for k, v in named.items())))).alias("__m"))
    measured = measured.select(*keep, "__m.*")
    failed = {r.name: rule_sql(r) for r in rules}
    base_sql = " OR ".join(failed[b] for b in base if b in failed) or "false"
    return measured.withColumns({
        "base_failed": F.expr(base_sql),
        "kept": F.expr("NOT (" + (" OR ".join(failed.values()) or "false") + ")"),
        "failed_rules": F.expr("concat_ws(',', " + (", ".join(f"IF({s}, '{n}', NULL)" for n, s in failed.items()) or "''") + ")"),
    })
