"""Brute-force versions of the contracts, in plain Python over whole rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(LOWER)


def words(text):
    return WORD.findall(low(text))


def license_base(text):
    w, starts, labels = words(text), [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def shingles(text):
    w = TOKEN.findall(low(text))
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def jaccard(docs, percent=75):
    """{index: component id} by comparing all documents that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in where[g] if j > i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        least[r] = min([x for x in (least.get(r), doc) if x is not None], default=None)
    return [(doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(docs)]


def decontaminated(docs, items):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated)"""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i : i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


ASSIGN = re.compile(r"((?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base_spans(text):
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    spans.sort(key=lambda s: (s[1], order[s[0]]))
    n = Counter(k for k, *_ in spans)
    digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    return n["assign"], n["access"], n["hex"], digest


def quality_base(text):
    text = text or ""
    w = TOKEN.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if TOKEN.search(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(zip(w, w[1:], w[2:]))
    rep = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(rep), failed


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def quality_verdicts(rows, margin=3.0, least_spread=0.03):
    """id -> (kept, class_distance, word_distance) of rows (id, text, lang)."""
    import math
    import string
    import unicodedata
    from statistics import quantiles

    from tagloom.llm.quality_rules import COMMON_WORDS

    facts = []
    for i, text, lang in rows:
        t = text or ""
        tokens = re.findall(r"[^\x20\x09-\x0D]+", t)
        classes = [0] * 5
        for ch in t:
            kind = unicodedata.category(ch)
            classes[3 if ch in " \t\n\x0b\x0c\r" else 1 if kind == "Lu" else 0 if kind[0] == "L" else 2 if kind == "Nd" else 4] += 1
        words = None
        if lang in COMMON_WORDS:
            stripped = [low(w).strip(string.punctuation) for w in tokens]
            words = [stripped.count(w) for w in COMMON_WORDS[lang]]
            words.append(len(tokens) - sum(words))
        facts.append((i, lang, len(tokens), classes, words, quality_base(text)[-1]))

    def distance(p, q):
        if not p or not q or not sum(p) or not sum(q):
            return None
        total = 0.0
        for x, y in zip([v / sum(p) for v in p], [v / sum(q) for v in q]):
            total += sum(v * math.log2(2 * v / (x + y)) / 2 for v in (x, y) if v)
        return math.sqrt(max(0.0, total))

    learned = {(lang, n, tuple(c), w and tuple(w)) for _, lang, n, c, w, failed in facts if not failed}
    refs = {}
    for lang, _, c, w in learned:
        both = refs.setdefault(lang, ([0] * 5, w and [0] * 13))
        for h, into in ((c, both[0]), (w, both[1])):
            for k, v in enumerate(h or []):
                into[k] += v * 10**6 // sum(h)
    spread = {}
    for lang, n, c, w in learned:
        for k, d in enumerate((distance(c, refs[lang][0]), distance(w, refs[lang][1]))):
            if d is not None:
                spread.setdefault((lang, n.bit_length(), k), []).append(math.floor(1000 * d))
    out = {}
    for i, lang, n, c, w, failed in facts:
        ref = refs.get(lang, (None, None))
        pair = [distance(c, ref[0]), distance(w, ref[1])] if n >= 50 else [None, None]
        far = False
        for k, d in enumerate(pair):
            seen = spread.get((lang, n.bit_length(), k))
            if d is not None and seen:
                q1, _, q3 = quantiles(seen, n=4, method="inclusive") if len(seen) > 1 else seen * 3
                far |= d > (q3 + margin * max(q3 - q1, 1000 * least_spread)) / 1000
        out[i] = (not failed and not far, *pair)
    return out


def url_rule(url):
    _, sep, rest = (url or "").partition("://")
    host = path = ""
    if sep:
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = low(host)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def archived(pages):
    first, out = {}, []
    for page, _, html in pages:
        b = (html or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, page), page)
    for page, _, html in pages:
        b = (html or "").encode()
        again = len(b) >= 100 and first[b] != page
        out.append((page, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return out


def crc_of_ids(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def repaired(rows):
    """The contract of conversation repair: damage, faults, cheapest edits, per conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        show = [" " if x is None else x for x in (conv, turn, role, text)]
        fate = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        row = (turn, "user" if fate == 4 else show[2], "" if fate == 1 else re.sub("[.!?]", "", show[3]) if fate == 2 else show[3])
        kept += [] if fate == 0 else [row, row] if fate == 3 else [row]
    legal = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [t for t, *_ in kept if t is not None]
        seen, faults = set(), []
        for _, role, text in kept:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "ok")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") or not (a and b) for a, b in zip(initials, initials[1:]))
        best = {}
        for i in range(len(kept), -1, -1):
            here = {q: [(0, "", ())] if i == len(kept) and q in (0, 3) else [] for q in range(4)}
            if i < len(kept):
                _, role, text = kept[i]
                extra = 5 if faults[i] == "truncated" else 0
                for q in range(4):
                    def add(cost, letter, to, line):
                        c, a, ls = best[to]
                        here[q].append((c + cost, letter + a, (line, *ls) if line is not None else ls))
                    add(2, "D", q, None)
                    if faults[i] in ("ok", "truncated"):
                        if (q, role[:1]) in legal:
                            add(extra, "K", legal[q, role[:1]], f"{role}:{text}")
                        for new in ("user", "assistant"):
                            if (q, new[0]) in legal:
                                add(1 + extra, "R", legal[q, new[0]], f"{new}:{text}")
            for _ in range(4):  # inserts, until nothing gets better
                for q in range(4):
                    for new in ("user", "assistant"):
                        if (q, new[0]) in legal and here[legal[q, new[0]]]:
                            c, a, ls = min(here[legal[q, new[0]]])
                            here[q].append((c + 5, "I" + a, (f"{new}:", *ls)))
                    here[q] = [min(here[q], key=lambda x: x[:2])] if here[q] else []
            best = {q: here[q][0] for q in range(4)}
        cost, audit, lines = best[0]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(faults)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=20):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(d, Counter(TERM.findall(low(t)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms, found = TERM.findall(low(text)), []
        for d, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms if t in b)
            if score > 0:
                found.append((-score, d is not None, d))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out
