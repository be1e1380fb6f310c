"""Quality rules: base counts, and the distance of a text's histograms from its language's.

Native: DataFrame functions only. Each text is read once into a narrow row of counts, which is written. The
method's verdict is by Jensen-Shannon distance (base 2, from 0 to 1) between the histograms of a text and the
reference of its language: of character classes, and of common words (A-Z lower-cased, ASCII punctuation taken
off both ends; every other word falls into one more cell).

* Reference: the mean of the texts' shares, so a huge text counts no more than a short one.
* Bound: by language and by length (powers of two of the word count, as short texts scatter more), the third
  quartile of the distances plus ``margin`` times the spread between the quartiles, or ``margin * least_spread`` if that is more.
  Distances are counted in thousandths for it, so a quartile needs at most 1,001 counts whatever the corpus.
* Both are learned from every text of at least ``min_words`` words that passes the base rules; equal rows of counts
  of a language (copies) are taken once there.

Texts of fewer than ``min_words`` words are not judged by the method (their histograms say little). A null or unlisted
language has no common-word histogram; its texts are judged by character classes, against their like. Fewer than five
texts of a language and length reject none of themselves, and where nothing was learned nothing is rejected.

Null and empty texts: all counts 0, ``base_failed``. Ties: a distance equal to the bound is kept. Repeated rows each
give a row. Very long texts are read whole, like any other. An empty table gives no rows. Extra columns are not
carried, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import TOKEN, ascii_lower, matches, written

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CLASSES = ["letter", "upper", "digit", "space", "other"]
PUNCTUATION = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
#: Shares are summed as whole millionths: the same sum in any order.
SHARE = 1_000_000

#: Common function words of each language, lower case.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "das", "von", "zu", "mit", "sich", "des", "auf", "ist"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "on", "by"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "con"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "est", "dans", "pour"],
}
N_COMMON = 12


def _without(c: Column, chars: str) -> Column:
    return reduce(lambda a, ch: F.replace(a, F.lit(ch), F.lit("")), chars, c)


def repeated_words(words: Column, grams: Column) -> Column:
    """Words that stand in a 3-word window found twice or more; ``grams``: a hash per window.

    Windows are sorted by (hash, place); equal neighbours are repeats. The sorted places
    of repeats cover min(3, gap to the next) words each. No step is quadratic."""
    pairs = F.sort_array(F.transform(grams, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

    def places(p):
        marked = F.transform(p, lambda x, k: F.when(
            (x["v"] == F.get(p, k - 1)["v"]) | (x["v"] == F.get(p, k + 1)["v"]), x["i"]))
        return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))

    def covered(q):
        steps = F.transform(q, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(q, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    # an array of one element serves to name a value once
    step = F.transform(F.array(pairs), places)
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(
        F.element_at(F.transform(step, covered), 1))


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: base counts and both histograms (arrays of counts)."""
    t = F.col("_t")
    read = docs.select("doc_id", F.col(lang_col).alias("_lang"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    split = read.select("doc_id", "_lang", "_t", matches(t, f"({TOKEN})").alias("_w"), _without(t, SPACES).alias("_solid"))
    w = F.col("_w")
    grams = F.when(F.size(w) > 2, F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                                              lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
                   ).otherwise(F.array().cast("array<bigint>"))
    lists = F.create_map(*[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    every = sorted({x for v in COMMON_WORDS.values() for x in v})
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    a = split.select(
        "doc_id", "_lang", "_w", "_solid", lines.alias("_lines"), grams.alias("_grams"), F.length(t).alias("_n"),
        F.regexp_replace(t, r"\p{L}+", "").alias("_rest"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).alias("_upper"),
        F.when(F.col("_lang").isin(*COMMON_WORDS), F.filter(F.transform(w, lambda x: F.btrim(ascii_lower(x), F.lit(PUNCTUATION))), lambda x: x.isin(every))).alias("_known"),
        lists[F.col("_lang")].alias("_list"))
    n, rest = F.col("_n"), F.col("_rest")
    letters, digits = n - F.length(rest), F.length(rest) - F.length(F.regexp_replace(rest, r"\p{Nd}+", ""))
    spaces = n - F.length("_solid")
    hist = [letters - F.col("_upper"), F.col("_upper"), digits, spaces, n - letters - digits - spaces]
    known = F.transform("_list", lambda x: F.size(F.filter("_known", lambda y: x == y)).cast("long"))
    return a.select(
        "doc_id", F.col("_lang").alias("lang"), F.size(w).cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        (F.length("_solid") - F.length(_without(F.col("_solid"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(w, F.col("_grams")).alias("n_repeat_words"),
        F.array(*[x.cast("long") for x in hist]).alias("class_hist"),
        F.concat(known, F.array(F.size(w) - F.aggregate(known, F.lit(0).cast("long"), lambda x, y: x + y))).alias("word_hist"))


def learned_from(rows: DataFrame, min_words: int) -> DataFrame:
    """The rows of counts that references and bounds are learned from."""
    return rows.where((F.col("n_words") >= min_words) & ~base_failed()).select("lang", "n_words", "class_hist", "word_hist").distinct()


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def references(rows: DataFrame) -> DataFrame:
    """Per language: the texts' shares of either histogram, in millionths, summed."""
    def summed(hist: str, n: int) -> tuple[Column, Column]:
        total = F.aggregate(hist, F.lit(0).cast("long"), lambda a, x: a + x)
        cells = [F.sum(F.expr(f"{hist}[{i}] * {SHARE}L div _total_{hist}")) for i in range(n)]
        return total.alias(f"_total_{hist}"), F.array(*cells)

    (class_total, class_ref), (word_total, word_ref) = summed("class_hist", len(CLASSES)), summed("word_hist", N_COMMON + 1)
    refs = rows.select("*", class_total, word_total).groupBy("lang").agg(
        class_ref.alias("_ref_class"), F.when(F.count("word_hist") > 0, word_ref).alias("_ref_word"))
    return refs.withColumnRenamed("lang", "_ref")


def distances(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """``rows`` with both distances, and ``band``: the number of binary digits of the word count."""
    return rows.join(refs, F.col("lang").eqNullSafe(F.col("_ref")), "left").withColumns({
        "class_distance": js_distance(F.col("class_hist"), F.col("_ref_class")),
        "word_distance": js_distance(F.col("word_hist"), F.col("_ref_word")),
        "band": F.length(F.bin("n_words"))}).drop("_ref", "_ref_class", "_ref_word")


def bounds(judged: DataFrame, margin: float, least_spread: float) -> DataFrame:
    """Per language and band the largest distances that are kept."""
    names = ("class_distance", "word_distance")
    quartiles = judged.groupBy(F.col("lang").alias("_lang"), F.col("band").alias("_band")).agg(
        *[F.percentile(F.floor(F.col(c) * 1000), [0.25, 0.75]).alias(c) for c in names])

    def most(c: str) -> Column:
        first, third = F.get(c, F.lit(0)), F.get(c, F.lit(1))
        return (third + margin * F.greatest(third - first, F.lit(1000.0 * least_spread))) / 1000

    return quartiles.select("_lang", "_band", *[most(c).alias(f"_most_{c}") for c in names])


def _shares(hist: Column) -> Column:
    total = F.aggregate(hist, F.lit(0).cast("double"), lambda a, x: a + x)
    return F.transform(hist, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms of counts; null where one is empty."""
    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(_shares(p), _shares(q), lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    filled = [F.aggregate(h, F.lit(0).cast("double"), lambda a, x: a + x) > 0 for h in (p, q)]
    return F.when(filled[0] & filled[1], F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x))))


def quality_rules(docs: DataFrame, min_words: int = 50, margin: float = 3.0, least_spread: float = 0.03,
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, ``base_failed``, both distances (null where not judged) and ``kept``."""
    rows = written(counts(docs, text_col, lang_col), "quality_counts")
    sample = learned_from(rows, min_words)
    refs = written(references(sample), "quality_references")
    most = written(bounds(distances(sample, refs), margin, least_spread), "quality_bounds")
    d = distances(rows, refs).join(most, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("band") == F.col("_band")), "left")
    judged = F.col("n_words") >= min_words
    far = F.lit(False)
    for c in ("class_distance", "word_distance"):
        far = far | F.coalesce(judged & (F.col(c) > F.col(f"_most_{c}")), F.lit(False))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
                    *[F.when(judged, F.col(c)).alias(c) for c in ("class_distance", "word_distance")],
                    (~base_failed() & ~far).alias("kept"))
