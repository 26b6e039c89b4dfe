"""Quality rules: a table of thresholds compiled into one projection.

No shuffle and no user function; every figure of a row comes from its own text.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.common import words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"
#: Shorter texts can do without a stop word.
JUDGED_WORDS = 30

# Frequent function words of English, German, French and Spanish.
STOP_WORDS_OF = {
    "en": "the of and to a in that is was for on with by at from as it be this are or an not",
    "de": "der die und das in zu den von mit ist im für auf des sich dem ein eine nicht als auch",
    "fr": "de la le et les des un une du en que est pour dans qui par sur pas avec au ce il",
    "es": "el los las y del se con una por para su al lo como más o es no",
}
STOP_WORDS = " ".join(STOP_WORDS_OF.values()).split()
LISTED = tuple(STOP_WORDS_OF)


class Rule(NamedTuple):
    """A figure that must lie between `least` and `most`."""

    name: str
    figure: Column
    least: float | None = None
    most: float | None = None


def default_rules() -> list[Rule]:
    """Rules over the columns that `figures` adds and is_listed. Ratios of an empty text are null and pass.

    Stop words are judged only where the language's are listed: a clean text in another one has none.
    """
    return [
        Rule("words", F.col("n_words"), MIN_WORDS, None),
        Rule("mean_word_length", F.col("word_chars") / F.nullif(F.col("n_words"), F.lit(0)), 2.0, 20.0),
        Rule("symbols_per_word", F.col("n_symbols") / F.nullif(F.col("n_words"), F.lit(0)), None, 0.2),
        Rule("stop_words", F.when(F.col("is_listed") & (F.col("n_words") >= JUDGED_WORDS), F.col("n_stop_words") / F.col("n_words")), 0.02, None),
        Rule("repeated_lines", F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)), None, 0.4),
        Rule("repeated_words", 100 * F.col("n_repeat_words") / F.nullif(F.col("n_words"), F.lit(0)), None, MAX_REPEAT_PERCENT),
    ]


def repeat_words(ws: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more in the text, the first included.

    Windows are hashed, and hashes sorted with their places; equal neighbours are repeats. Each
    repeated window adds what it covers up to the next one. Linear but for the sort; a text whose
    hashes are all different skips it.
    """
    n = F.size(ws)
    hashes = F.when(
        n >= window,
        F.transform(
            F.sequence(F.lit(0), n - window), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(window)])
        ),
    ).otherwise(F.array().cast("array<long>"))

    def covered(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda a, b: (a["h"] == b["h"]) & a["h"].isNotNull()
        places = lambda o: F.sort_array(
            F.transform(
                F.filter(
                    o,
                    lambda x, j: F.coalesce(same(x, F.get(o, j - 1)), F.lit(False))
                    | F.coalesce(same(x, F.get(o, j + 1)), F.lit(False)),
                ),
                lambda x: x["i"],
            )
        )
        return once(once(ordered, places), lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window)))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ))

    return once(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)))


def once(value: Column, use) -> Column:
    """use(value) with the value worked out once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds _figures: a struct of all counts of a text. Null counts as empty.

    It is exploded from an array of one, so that a filter above reads the counts; pushed below, it
    would work them out again for every rule.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def counts(ws: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        lower = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            once(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            repeat_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.array_contains(lower, F.lower(w)))).cast("long").alias("n_stop_words"),
        )

    return docs.withColumn("_figures", F.explode(F.array(once(words(text), counts))))


def verdicts(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    listed: Sequence[str] = LISTED,
) -> DataFrame:
    """One row per document: id, counts, base_failed, failed (names of rules), kept.

    `listed` are the languages (values of `lang_col`) whose stop words are judged; a document of another
    language, of none, or of a table without the column is not judged by them.

    A null text is an empty one and fails the least number of words. Rules over a ratio whose
    denominator is 0 pass. Equal rows get equal verdicts; an empty table gives no rows; other
    columns are ignored.
    """
    rules = default_rules() if rules is None else rules
    known = F.coalesce(F.col(lang_col).isin(*listed), F.lit(False)) if lang_col in docs.columns else F.lit(False)
    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), known.alias("is_listed"))
    flat = figures(given, "_text").select(
        "_id",
        "is_listed",
        *[f"_figures.{c}" for c in ("n_words", "word_chars", "n_symbols")],
        F.col("_figures.lines.n").alias("n_lines"),
        F.col("_figures.lines.dup").alias("n_dup_lines"),
        *[f"_figures.{c}" for c in ("n_repeat_words", "n_stop_words")],
    )
    failed = F.array_compact(F.array(*[F.when(_outside(r), F.lit(r.name)) for r in rules]))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return flat.select(
        F.col("_id").alias(id_col),
        *[c for c in flat.columns if c not in ("_id", "is_listed")],
        base.alias("base_failed"),
        failed.alias("failed"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )


def _outside(rule: Rule) -> Column:
    low = rule.figure < rule.least if rule.least is not None else F.lit(False)
    high = rule.figure > rule.most if rule.most is not None else F.lit(False)
    return F.coalesce(low | high, F.lit(False))


def keep_good(
    docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text", lang_col: str = "lang", listed: Sequence[str] = LISTED
) -> DataFrame:
    """The documents that pass, all columns as they were; one projection, no join."""
    lang = [F.col(lang_col).alias("_lang")] if lang_col in docs.columns else []
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"), *lang)
    kept = verdicts(own, rules, "_row", "_text", "_lang", listed)
    return kept.filter("kept").select("_row.*")
