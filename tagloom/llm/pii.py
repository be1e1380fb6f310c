"""Personal data by weak supervision.

Native: DataFrame functions only; the driver sees one table of vote patterns, of at most kinds x 3^labelers rows, whatever the corpus.

1. Candidates are found per kind by patterns over the whole text, with the text before and behind them.
2. Labelers vote on each candidate: +1 private, -1 not, 0 no opinion. ``format`` checks what a value of that kind must satisfy, ``gazetteer`` looks
   into lists (given names, mail providers, role accounts, countries), ``before`` and ``behind`` read the context, ``alone`` sees whether
   the candidate is a piece of something longer.
3. Expectation-maximisation over the counted vote patterns estimates a share of private candidates per kind and, per labeler, how
   often it votes how on private and on other candidates. A candidate that no labeler votes for counts as not private throughout.
4. The posteriors are the training labels of the final span classifier, a naive Bayes model on words around the candidate, its shape, its length and
   its edges, with hashed features (``BUCKETS`` per feature). It decides on the candidates of the further kinds; base spans always stay. A further candidate that
   overlaps a base span goes.

Labels are counted in millionths, as whole numbers, so sums do not hang on their order. Rows that hold many candidates meet one task per document, never more
than one text has. Null and empty texts have no spans; repeated rows each give a row; ties cannot occur, as a span has one place per kind; an
empty table gives no rows; without private candidates nothing is added to the base. Patterns match any text in linear time and without deep recursion,
so very long texts are scanned whole. Only id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import ascii_lower, literal_table, small, text_key, written

#: Fixed values of the contract: kinds and patterns of the base, written so that Java matches them without recursion (possessive
#: repeats) and reads no stretch from each of its places (a candidate starts where its run starts, or at the end of the last match).
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = [
    ("email", rf"((?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)"),
    ("ip", r"((?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)"),
    ("card", r"([0-9](?:[\x20-]?[0-9]){15,}+)"),
    ("phone", r"(\+[0-9][\x20().0-9-]+[0-9])"),
]
#: The method's further kinds.
NAME_WORD = r"\p{Lu}\p{Ll}{1,20}"
MORE = [
    ("iban", r"((?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9]))"),
    ("idnumber", r"((?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-]))"),
    ("birthdate", r"((?<![0-9A-Za-z./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9A-Za-z-]))"),
    ("national", r"((?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20./-][0-9]{3,5}(?![0-9A-Za-z-]))"),
    ("name", rf"((?<![\p{{L}}\p{{N}}]){NAME_WORD}(?:\x20{NAME_WORD}){{1,2}}(?![\p{{L}}\p{{N}}]))"),
    ("address", rf"((?<![\p{{L}}\p{{N}}])(?:[0-9]{{1,5}}\x20(?:{NAME_WORD}\x20){{1,3}}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Court|Square)"
                rf"|{NAME_WORD}(?:straße|strasse|weg|platz|allee|gasse)\x20[0-9]{{1,4}}[a-z]?"
                rf"|(?:rue|avenue|calle|avenida|plaza)\x20(?:de\x20|del\x20|des\x20|du\x20|la\x20){{0,2}}{NAME_WORD},?\x20[0-9]{{1,4}})(?![\p{{L}}\p{{N}}]))"),
]
PATTERNS = BASE + MORE
KINDS = [k for k, _ in PATTERNS]
#: What a text must hold to be searched for a kind, where a plain string tells.
HOLDS = {"email": "@", "phone": "+"}

#: Word lists of the labelers (own choice, public knowledge).
GIVEN = ("james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth susan jessica sarah karen anna "
         "hans peter klaus jürgen stefan andreas thomas monika petra sabine ursula jean pierre marie michel philippe nathalie isabelle sophie "
         "josé juan carlos luis miguel javier maría carmen ana laura pablo lucía maria jose").split()
ROLES = "info noreply no-reply support admin sales contact office webmaster postmaster newsletter".split()
PROVIDERS = "gmail.com yahoo.com hotmail.com outlook.com icloud.com gmx.de web.de t-online.de orange.fr free.fr wanadoo.fr telefonica.net".split()
IBAN_COUNTRIES = "AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
STARTS = "the a an in on at der die das ein eine und im le la les un une et el los las en y de".split()
#: Words shortly before a candidate that speak for it, by kind, and against any.
CUES = {
    "email": "mail email e-mail contact write correo courriel kontakt", "ip": "ip address login logged host from adresse",
    "card": "card visa mastercard credit karte kreditkarte carte tarjeta", "phone": "phone tel telephone call mobile fax telefon téléphone teléfono",
    "iban": "iban account konto compte cuenta bank", "idnumber": "ssn social security id number sozialversicherung",
    "birthdate": "born birth dob birthday geboren geburtsdatum né née naissance nacido nacida nacimiento",
    "national": "phone tel telephone call mobile fax telefon téléphone teléfono", "name": "mr mrs ms dr name prof herr frau monsieur madame señor señora signed",
    "address": "address lives at street adresse wohnt wohnhaft dirección habite",
}
AGAINST = "version isbn issn order page figure chapter section example sample article build model line".split()
UNITS = "percent km kg mm cm eur usd euro euros dollars pages times".split()
LABELERS = ["by_format", "by_gazetteer", "by_before", "by_behind", "by_alone"]

ROUNDS = 30
BUCKETS = 1 << 14
HELD = 4
FEATURES = ["w1", "w2", "next", "shape", "size", "edges"]
ONE = 1_000_000
#: Chance of a vote (-1, 0, +1) before any data, on other and on private candidates.
#: Weight of what is assumed before any data, as a part of all candidates.
ANCHOR = 1.0
START = {0: (0.4, 0.5, 0.1), 1: (0.01, 0.49, 0.5)}


def _words(c: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(c), F.lit(r"([\p{L}\p{N}-]+)"))


def _in(c: Column, words) -> Column:
    return c.isin(*words)


def _any(words: Column, listed) -> Column:
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in dict.fromkeys(listed)]))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``_row``, ``_key`` and ``found``: an array of (kind, k, gap, hit, before, behind); gap is the length
    of the text before the hit, back to the last hit of its kind."""
    t = F.col("_t")
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,hit:string,before:string,behind:string>>")

    def of_kind(n: int, kind: str, p: str) -> Column:
        gaps, hits = F.split(t, p, -1), F.regexp_extract_all(t, F.lit(p), F.lit(0))
        each = F.zip_with(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("g"), hits.alias("h")), F.slice(gaps, F.lit(2), F.size(hits)),
                          lambda x, z: F.struct(F.length(x["g"]).alias("gap"), x["h"].alias("hit"), F.right(x["g"], F.lit(40)).alias("before"),
                                                F.left(z, F.lit(24)).alias("behind")))
        found = F.transform(each, lambda x, i: F.struct(F.lit(n).alias("kind"), i.alias("k"), x["gap"].alias("gap"), x["hit"].alias("hit"),
                                                        x["before"].alias("before"), x["behind"].alias("behind")))
        return F.when(t.contains(HOLDS[kind]) if kind in HOLDS else t.rlike(p), found).otherwise(none)

    base = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return base.select("doc_id", "_row", text_key(t), F.concat(*[of_kind(n, k, p) for n, (k, p) in enumerate(PATTERNS)]).alias("found"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right counts twice (digits of the double added)."""
    back = F.split(F.reverse(digits), "")
    parts = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def iban_rest(value: Column) -> Column:
    """The number of an IBAN (first four characters last, letters as two digits) modulo 97."""
    solid = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(solid, F.lit(5), F.length(solid)), F.left(solid, F.lit(4))), "")
    return F.aggregate(turned, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def valid_base(kind: Column, hit: Column) -> Column:
    """Whether a match of a base kind stands (others do)."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return (F.when(kind == 1, hit.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == 2, F.length(digits).between(16, 19) & F.when(F.length(digits) <= 19, luhn(digits)).otherwise(F.lit(False)))
            .when(kind == 3, F.length(digits).between(8, 15)).otherwise(F.lit(True)))


def spans_of(found: DataFrame) -> DataFrame:
    """doc_id, _row, _key, kind, start, end, hit, before, behind: all base spans, and candidates of further kinds that overlap none of them."""
    x = found.select("doc_id", "_row", "_key", F.inline("found"))
    w = Window.partitionBy("_row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.length("hit")).cast("long")).over(w)
    x = x.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit")).where(valid_base(F.col("kind"), F.col("hit")))
    base = F.col("kind") < len(BASE)
    order = Window.partitionBy("_row").orderBy("start", "kind")
    last = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # spans that start at the same place as a base span meet it whichever comes first in the order
    following = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = (F.coalesce(last, F.lit(0)) <= F.col("start")) & (following.isNull() | (following >= F.col("end")))
    return x.withColumn("_free", base | free).where("_free").select(
        "doc_id", "_row", "_key", "kind", "start", "end", "hit", "before", "behind")


def votes(spans: DataFrame) -> DataFrame:
    """``spans`` with a column ``by_<labeler>`` of -1, 0 or +1 each."""
    hit, low = F.col("hit"), ascii_lower(F.col("hit"))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    plus, minus, none = F.lit(1), F.lit(-1), F.lit(0)

    def is_(kind):
        return F.col("kind") == KINDS.index(kind)

    def either(test, yes=plus, no=minus):
        return F.when(test, yes).otherwise(no)

    numbers = F.transform(F.regexp_extract_all(hit, F.lit("([0-9]+)")), lambda d: d.try_cast("int"))
    day_month = F.when(F.length(F.element_at(F.regexp_extract_all(hit, F.lit("([0-9]+)")), 1)) == 4, F.array(F.get(numbers, F.lit(2)), F.get(numbers, F.lit(1)))).otherwise(
        F.array(F.get(numbers, F.lit(0)), F.get(numbers, F.lit(1))))
    possible = (F.least(day_month[0], day_month[1]).between(1, 12)) & (F.greatest(day_month[0], day_month[1]).between(1, 31))
    format_ = (F.when(is_("email"), either(hit.rlike(r"\.[A-Za-z]{2,24}$")))
               .when(is_("ip"), either(~hit.rlike(r"(^|\.)0[0-9]")))
               .when(is_("card"), either(digits.rlike("^[3-6]"), plus, none))
               .when(is_("phone"), either(n >= 10, plus, none))
               .when(is_("iban"), either(iban_rest(hit) == 1))
               .when(is_("idnumber"), either(~hit.rlike(r"^(000|666|9)|-00-|-0000$")))
               .when(is_("birthdate"), either(possible, none, minus))
               .when(is_("national"), either(n.between(7, 11), none, minus)).otherwise(none))
    words = _words(hit)
    local, domain = F.substring_index(low, "@", 1), F.substring_index(low, "@", -1)
    gazetteer = (F.when(is_("email") & _in(local, ROLES), minus).when(is_("email") & _in(domain, PROVIDERS), plus)
                 .when(is_("ip") & hit.rlike(r"^(0|10|127|192\.168|255)\."), minus)
                 .when(is_("iban"), either(_in(F.left(hit, F.lit(2)), IBAN_COUNTRIES)))
                 .when(is_("name") & _any(words, GIVEN), plus).when(is_("name") & _any(words, STARTS), minus)
                 .when(is_("address"), plus).otherwise(none))
    near = F.slice(F.concat(F.array(F.lit("")), F.array(F.lit("")), F.array(F.lit("")), _words(F.col("before"))), -3, 3)
    cue = F.lit(False)
    titled = F.concat(near, F.when(is_("name"), words).otherwise(F.array(F.lit(""))))  # a title may be the first word of a name
    for kind, listed in CUES.items():
        cue = F.when(is_(kind), _any(titled, listed.split())).otherwise(cue)
    before = F.when(_any(near, AGAINST), minus).when(cue, plus).otherwise(none)
    next_ = F.get(_words(F.col("behind")), F.lit(0))
    behind = F.when(F.coalesce(_in(next_, UNITS), F.lit(False)) | F.col("behind").rlike(r"^[%€$]"), minus).otherwise(none)
    joined = F.col("before").rlike(r"[\p{L}\p{N}_/=]$") | F.col("behind").rlike(r"^[\p{L}\p{N}_/=@]")
    return spans.withColumns(dict(zip(LABELERS, [format_, gazetteer, before, behind, either(joined, minus, none)])))


def estimate(counted: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, tuple[int, ...]], int]:
    """Millionths of being private by (kind, votes), by expectation-maximisation over (kind, votes, count).

    Every estimate is drawn towards its start (``START``, an even share) with the weight of ``ANCHOR`` times all candidates: what a vote means stays
    anchored, and a kind whose candidates vote alike can't become a class of its own. The result doesn't hang on the corpus's size."""
    total = max(1, sum(n for *_, n in counted))
    chance = [{y: list(START[y]) for y in (0, 1)} for _ in LABELERS]
    share = dict.fromkeys({k for k, *_ in counted}, 0.5)
    counted = sorted(counted)
    post: dict = {}
    for _ in range(rounds):
        for kind, v, _n in counted:
            if 1 not in v:
                post[kind, v] = 0.0
                continue
            a, b = math.log(share[kind]), math.log(1 - share[kind])
            for who, x in zip(chance, v):
                a, b = a + math.log(who[1][x + 1]), b + math.log(who[0][x + 1])
            post[kind, v] = 1 / (1 + math.exp(min(700.0, b - a)))
        for kind in share:
            own = [(n, post[k, v]) for k, v, n in counted if k == kind]
            size = sum(n for n, _ in own)
            share[kind] = (sum(n * p for n, p in own) + ANCHOR * size / 2) / ((1 + ANCHOR) * size)
        for at, who in enumerate(chance):
            for y in (0, 1):
                by = [ANCHOR * total * x for x in START[y]]
                for k, v, n in counted:
                    by[v[at] + 1] += n * (post[k, v] if y else 1 - post[k, v])
                who[y] = [x / sum(by) for x in by]
    return {key: round(p * ONE) for key, p in post.items()}


def features(spans: DataFrame) -> DataFrame:
    """``spans`` with a bucket per feature of the classifier."""
    none = F.array(F.lit(""), F.lit(""))
    near = F.concat(none, _words(F.col("before")))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("hit"), "[0-9]+", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")
    edge = F.concat(F.right("before", F.lit(1)), F.lit("|"), F.left("behind", F.lit(1)))
    edge = F.regexp_replace(F.regexp_replace(edge, r"[\p{L}\p{N}]", "w"), r"[\x20\x09-\x0D]", " ")
    values = [F.element_at(near, -1), F.element_at(near, -2), F.coalesce(F.get(_words(F.col("behind")), F.lit(0)), F.lit("")), shape,
              F.least(F.floor(F.length("hit") / 4), F.lit(10)).cast("string"), edge]
    return spans.withColumns({f"_{name}": F.pmod(F.xxhash64(F.lit(name), "kind", v), F.lit(BUCKETS)).cast("int") for name, v in zip(FEATURES, values)})


def classifier(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, prior; feature, kind, bucket, weight) of the naive Bayes model from rows with ``private`` in millionths."""
    private, other = F.sum("private").alias("p"), F.sum(ONE - F.col("private")).alias("o")
    share = (F.sum("private") + F.lit(ONE)) / (F.count(F.lit(1)) * ONE + F.lit(2 * ONE))
    priors = labelled.groupBy("kind").agg(share.alias("share"))
    tables = []
    for name in FEATURES:
        by = labelled.groupBy("kind", F.col(f"_{name}").alias("bucket")).agg(private, other).join(F.broadcast(priors), "kind")
        # a feature's odds, drawn towards its kind's odds as by HELD candidates of that kind: rare features weigh little
        s = F.col("share")
        odds = (F.col("p") + HELD * ONE * s) / (F.col("o") + HELD * ONE * (1 - s))
        tables.append(by.select(F.lit(name).alias("feature"), "kind", "bucket", (F.log(odds) - F.log(s / (1 - s))).alias("weight")))
    model = tables[0]
    for t in tables[1:]:
        model = model.unionByName(t)
    return priors.select("kind", F.log(F.col("share") / (1 - F.col("share"))).alias("prior")), model


def classified(rows: DataFrame, model: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``rows`` (with ``features``) with ``log_odds``. The model has at most kinds x features x ``BUCKETS`` rows."""
    priors, weights = model
    total = F.col("prior")
    rows = rows.join(F.broadcast(priors), "kind")
    for name in FEATURES:
        own = weights.where(F.col("feature") == name).select("kind", F.col("bucket").alias(f"_{name}"), F.col("weight").alias(f"_x{name}"))
        rows = rows.join(F.broadcast(own), ["kind", f"_{name}"], "left")
        total = total + F.coalesce(F.col(f"_x{name}"), F.lit(0.0))
    return rows.withColumn("log_odds", total).drop("prior", *[f"_{n}" for n in FEATURES], *[f"_x{n}" for n in FEATURES])


def judged_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with ``_row``, spans with the labelers' votes, ``private`` in millionths and the classifier's ``log_odds``)."""
    found = written(candidates(docs, id_col, text_col), "pii_candidates")
    voted = written(features(votes(spans_of(found.where(F.size("found") > 0)))), "pii_votes")
    counted = [(r["kind"], tuple(r[x] for x in LABELERS), r["n"]) for r in voted.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()]
    post = estimate(counted)
    table = literal_table(docs.sparkSession, [(k, *v, p) for (k, v), p in sorted(post.items())], ["kind", *LABELERS, "private"], ["int"] * (len(LABELERS) + 1) + ["long"])
    labelled = written(voted.join(F.broadcast(table), ["kind", *LABELERS]), "pii_labelled")
    priors, weights = classifier(labelled)
    return found.select("doc_id", "_row"), classified(labelled, (priors, written(weights, "pii_model")))


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts per base kind, the digest of the base spans, all spans, and how many the method added."""
    rows, spans = judged_spans(docs, id_col, text_col)
    kept = spans.where((F.col("kind") < len(BASE)) | (F.col("log_odds") > 0))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    label = F.concat_ws(":", name, F.col("start"), F.col("end"))
    # the spans of one document meet in one row, which is no longer than its text
    per_doc = kept.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", label.alias("label")))).alias("_s"),
        *[F.count_if(F.col("kind") == n).alias(f"_n{n}") for n in range(len(BASE))], F.count_if(F.col("kind") >= len(BASE)).alias("_more"))
    zero = F.lit(0).cast("long")
    s = F.coalesce(F.col("_s"), F.array().cast("array<struct<kind:int,start:bigint,label:string>>"))

    def joined(a):
        return F.array_join(F.transform(a, lambda x: x["label"]), ",")

    return rows.join(per_doc, "_row", "left").select(
        "doc_id", *[F.coalesce(f"_n{n}", zero).alias(f"n_{k}") for n, (k, _) in enumerate(BASE)],
        F.sha2(joined(F.filter(s, lambda x: x["kind"] < len(BASE))), 256).alias("base_sha256"), joined(s).alias("spans"),
        F.coalesce("_more", zero).alias("n_more"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, e.g. ``<email>``; of overlapping spans the first (at one place the longest)
    stands for all it meets. All other text and all rows stay."""
    _, spans = judged_spans(docs, id_col, text_col)
    kept = spans.where((F.col("kind") < len(BASE)) | (F.col("log_odds") > 0)).groupBy("doc_id", "_key", "start", "end").agg(F.min("kind").alias("kind"))
    w = Window.partitionBy("doc_id", "_key").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    kept = kept.withColumn("_from", F.coalesce(F.max("end").over(w), F.lit(0).cast("long")))
    cuts = small(written(kept.groupBy(F.col("doc_id").alias("__id"), F.col("_key").alias("__k")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "_from", "kind"))).alias("__cuts"), F.max("end").alias("__last")), "pii_cuts"), entries="__cuts")
    joined = docs.join(cuts, docs[id_col].eqNullSafe(cuts["__id"]) & (text_key(docs[text_col]) == cuts["__k"]), "left")
    tag = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    t = F.coalesce(F.col(text_col), F.lit(""))
    before = F.array_join(F.transform("__cuts", lambda x: F.when(x["start"] >= x["_from"], F.concat(
        F.substring(t, (x["_from"] + 1).cast("int"), (x["start"] - x["_from"]).cast("int")), F.element_at(tag, x["kind"] + 1))).otherwise(F.lit(""))), "")
    new = F.when(F.col("__cuts").isNull(), F.col(text_col)).otherwise(F.concat(before, F.substring(t, (F.col("__last") + 1).cast("int"), F.lit(2**31 - 1))))
    return joined.withColumn(text_col, new).select(*docs.columns)
