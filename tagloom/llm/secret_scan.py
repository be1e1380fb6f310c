"""Secret scans with corpus-wide ownership frequency.

Native: DataFrame functions only.

Candidates are found per document by patterns; the place of each follows from the lengths
of the matches and of the text between them (running sums per document and kind). Every
candidate value is hashed and counted over the corpus by distinct repository and distinct
owner. A value held by ``min_owners`` owners or more is a widely copied ``example``; any
other looks ``live``, as its owner's own. A private key is one span from its BEGIN to its END line, and is
counted by its body.

Counts are pre-aggregated per (value, owner, repository), then per (value, owner), then
per value, so a value that stands in a third of all rows meets one task as a few rows.
Null and empty texts have no candidates. Repeated rows each give a row. Null owners or
repositories count as one more value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import small, text_key, written

#: Fixed values of the contract. Per kind: pattern, least length, and the pattern of the
#: part whose length counts (None: the whole match).
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)")
BASE = [("assign", ASSIGN, 6), ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]{24,})", 24)]
#: A private key: its BEGIN line, header lines (of encrypted keys), and the body up to the END line; without an
#: END line up to the last base64 line. Where no body follows, the BEGIN line alone. No step repeats a group without
#: bound or scans a stretch twice, so any text is matched in linear time and without deep recursion.
KEY_LINE = r"-----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----"
PRIVATE_KEY = (r"(-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?:\r?\n[\x20\t]*[A-Za-z][A-Za-z0-9-]*:[^\r\n]*){1,8}\r?\n)?"
               r"(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----"
               r"|[\s\x5C\x22\x27,]*[A-Za-z0-9+/=]{40,}(?:[A-Za-z0-9+/=\s\x5C\x22\x27,]*[A-Za-z0-9+/=]{40,})?"
               r"(?:\r?\n[\x20\t]*[A-Za-z0-9+/]+={0,2}(?m:$))?))?)")
#: Further kinds: public formats of tokens, with a string that any match holds.
MORE = [
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", "gh"),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", "eyJ"),
    ("privatekey", PRIVATE_KEY, "PRIVATE KEY-----"),
    ("slack", r"(xox[abprs]-[A-Za-z0-9-]{10,})", "xox"),
]
KINDS = [k for k, *_ in BASE] + [k for k, *_ in MORE]
PLACEHOLDER = "<secret>"


def _key_body(hit: Column) -> Column:
    """What makes one private key differ from others, however its lines are wrapped or quoted; the whole
    match where nothing but a BEGIN line is there."""
    body = F.regexp_replace(F.regexp_replace(hit, KEY_LINE, ""), r"\\[nrt]|[\s\x5C\x22\x27,]+", "")
    return F.when(body == "", hit).otherwise(body)


def _hint(text: Column, kind: str, pattern: str) -> Column:
    if kind == "access":
        return text.contains("AKIA")
    for k, _, holds in MORE:
        if k == kind:
            return text.contains(holds)
    return text.rlike(pattern)


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """One row per document: ``keep``, ``_row``, ``_key`` (hash of the text) and ``found``: an
    array of (kind, k, gap, hit), in which gap is the length of the text before the hit."""
    t = F.col("_t")
    patterns = [(k, p) for k, p, _ in BASE + MORE]
    base = docs.select(*keep, F.monotonically_increasing_id().alias("_row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,hit:string>>")

    def of_kind(n: int, kind: str, p: str) -> Column:
        gaps, hits = F.split(t, p, -1), F.regexp_extract_all(t, F.lit(p), F.lit(0))
        zipped = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits,
                            lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit")))
        numbered = F.transform(zipped, lambda x, i: F.struct(
            F.lit(n).alias("kind"), i.alias("k"), x["gap"].alias("gap"), x["hit"].alias("hit")))
        return F.when(_hint(t, kind, p), numbered).otherwise(none)

    per_kind = [of_kind(n, kind, p) for n, (kind, p) in enumerate(patterns)]
    return base.select(*keep, "_row", text_key(t), F.concat(*per_kind).alias("found"))


def spans_of(found: DataFrame, keep: list[str]) -> DataFrame:
    """All spans: ``keep``, ``_row``, ``kind`` (number), ``start``, ``end``, ``value_start``, ``value_hash``."""
    x = found.select(*keep, "_row", "_key", F.inline("found"))
    w = Window.partitionBy("_row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.length("hit")).cast("long")).over(w)
    value = F.when(F.col("kind") == 0, F.regexp_extract("hit", ASSIGN, 1)).otherwise(F.col("hit"))
    own = F.when(F.col("kind") == KINDS.index("privatekey"), _key_body(F.col("_v"))).otherwise(F.col("_v"))
    least = F.element_at(F.array(*[F.lit(n) for *_, n in BASE], *[F.lit(0) for _ in MORE]), F.col("kind") + 1)
    return (x.select(*keep, "_row", "_key", "kind", (end - F.length("hit")).alias("start"), end.alias("end"), value.alias("_v"))
            .where(F.length("_v") >= least)
            .select(*keep, "_row", "_key", "kind", "start", "end", (F.col("end") - F.length("_v")).alias("value_start"),
                    F.sha2(own, 256).alias("value_hash")))


def ownership(spans: DataFrame, owner: str, repo: str) -> DataFrame:
    """Per value hash: ``n_repos`` and ``n_owners`` (both distinct), over the whole corpus."""
    per_repo = spans.groupBy("value_hash", owner, repo).agg(F.lit(1).alias("_one"))
    per_owner = per_repo.groupBy("value_hash", owner).agg(F.count(F.lit(1)).alias("_repos"))
    return per_owner.groupBy("value_hash").agg(F.sum("_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def judged_spans(docs: DataFrame, owner: str = "source", repo: str = "doc_id", min_owners: int = 4,
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with their candidates, spans with ``verdict`` live or example)."""
    keep = list(dict.fromkeys([repo, owner]))
    found = written(candidates(docs, keep, text_col), "secret_candidates")
    spans = written(spans_of(found.where(F.size("found") > 0), keep), "secret_spans")
    owners = ownership(spans, owner, repo)
    verdict = F.when(F.col("n_owners") >= min_owners, F.lit("example")).otherwise(F.lit("live"))
    return found, spans.join(owners, "value_hash", "left").withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, owner: str = "source", repo: str = "doc_id", min_owners: int = 4,
                text_col: str = "text") -> DataFrame:
    """Per document: counts per base kind, the digest of the base spans, all spans, and how
    many spans look live or are widely copied examples."""
    found, spans = judged_spans(docs, owner, repo, min_owners, text_col)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    # the spans of one document meet in one row, which is no longer than its text
    per_doc = spans.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", label.alias("label")))).alias("_s"),
        *[F.count_if(F.col("kind") == n).alias(f"_n{n}") for n in range(len(BASE))],
        F.count_if(F.col("verdict") == "live").alias("_live"), F.count_if(F.col("verdict") == "example").alias("_example"))
    zero = F.lit(0).cast("long")
    s = F.coalesce(F.col("_s"), F.array().cast("array<struct<start:bigint,kind:int,label:string>>"))

    def joined(a):
        return F.array_join(F.transform(a, lambda x: x["label"]), ",")

    return (found.drop("found", "_key").join(per_doc, "_row", "left").select(
        F.col(repo).alias("doc_id"), *[F.coalesce(f"_n{n}", zero).alias(f"n_{k}") for n, (k, *_) in enumerate(BASE)],
        F.sha2(joined(F.filter(s, lambda x: x["kind"] < len(BASE))), 256).alias("base_sha256"),
        joined(s).alias("spans"), F.coalesce("_live", zero).alias("n_live"), F.coalesce("_example", zero).alias("n_example")))


def redact(docs: DataFrame, owner: str = "source", repo: str = "doc_id", min_owners: int = 4,
           text_col: str = "text") -> DataFrame:
    """``docs`` with every live-looking value replaced by ``<secret>``; examples, all other text
    and all rows stay. Only the few spans travel; a text moves only if they are too many to broadcast."""
    _, spans = judged_spans(docs, owner, repo, min_owners, text_col)
    w = Window.partitionBy(repo, "_key").orderBy("value_start", "end").rowsBetween(Window.unboundedPreceding, -1)
    live = (spans.where(F.col("verdict") == "live").groupBy(repo, "_key", "value_start", "end").agg(F.lit(1).alias("_one"))
            .withColumn("_from", F.coalesce(F.max("end").over(w), F.lit(0).cast("long"))))
    cuts = small(written(live.groupBy(F.col(repo).alias("__id"), F.col("_key").alias("__k")).agg(
        F.sort_array(F.collect_list(F.struct("value_start", "end", "_from"))).alias("__cuts"), F.max("end").alias("__last")),
        "secret_cuts"), entries="__cuts")
    t = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(cuts, docs[repo].eqNullSafe(cuts["__id"]) & (text_key(docs[text_col]) == cuts["__k"]), "left")
    before = F.array_join(F.transform("__cuts", lambda x: F.when(x["value_start"] >= x["_from"], F.concat(
        F.substring(t, (x["_from"] + 1).cast("int"), (x["value_start"] - x["_from"]).cast("int")), F.lit(PLACEHOLDER)))
        .otherwise(F.lit(""))), "")
    new = F.when(F.col("__cuts").isNull(), F.col(text_col)).otherwise(
        F.concat(before, F.substring(t, (F.col("__last") + 1).cast("int"), F.lit(2**31 - 1))))
    return joined.withColumn(text_col, new).select(*docs.columns)
