"""The contract of personal data, and the weak-supervision method, in plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import regex

from brute import low
from tagloom.llm import pii as P


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    """Spans by the contract's own patterns: (kind number, start, end)."""
    text, out = text or "", []
    out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def joined(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def words(text):
    return regex.findall(r"[\p{L}\p{N}-]+", low(text))


def vote(kind, hit, before, behind):
    name = P.KINDS[kind]
    digits, ws = re.sub("[^0-9]", "", hit), words(hit)
    numbers = [int(x) for x in re.findall("[0-9]+", hit)]
    near, nxt = words(before)[-3:], (words(behind) or [None])[0]
    f = g = 0
    if name == "email":
        f = 1 if re.search(r"\.[A-Za-z]{2,24}$", hit) else -1
        local, domain = low(hit).split("@")
        g = -1 if local in P.ROLES else 1 if domain in P.PROVIDERS else 0
    elif name == "ip":
        f = -1 if re.search(r"(^|\.)0[0-9]", hit) else 1
        g = -1 if re.match(r"(0|10|127|192\.168|255)\.", hit) else 0
    elif name == "card":
        f = 1 if digits[0] in "3456" else 0
    elif name == "phone":
        f = 1 if len(digits) >= 10 else 0
    elif name == "iban":
        solid = hit.replace(" ", "")
        f = 1 if int("".join(str(int(c, 36)) for c in solid[4:] + solid[:4])) % 97 == 1 else -1
        g = 1 if hit[:2] in P.IBAN_COUNTRIES else -1
    elif name == "idnumber":
        f = -1 if re.search("^(000|666|9)|-00-|-0000$", hit) else 1
    elif name == "birthdate":
        a, b = (numbers[2], numbers[1]) if numbers[0] > 999 else numbers[:2]
        f = 0 if 1 <= min(a, b) <= 12 and 1 <= max(a, b) <= 31 else -1
    elif name == "national":
        f = 0 if 7 <= len(digits) <= 11 else -1
    elif name == "name":
        g = 1 if set(ws) & set(P.GIVEN) else -1 if set(ws) & set(P.STARTS) else 0
    else:
        g = 1
    c = -1 if set(near) & set(P.AGAINST) else 1 if set(near + (ws if name == "name" else [])) & set(P.CUES[name].split()) else 0
    h = -1 if nxt in P.UNITS or re.match("[%€$]", behind) else 0
    alone = -1 if regex.search(r"[\p{L}\p{N}_/=]$", before) or regex.match(r"[\p{L}\p{N}_/=@]", behind) else 0
    return f, g, c, h, alone


def shapes(kind, hit, before, behind):
    near = ["", "", *words(before)]
    shape = regex.sub(r"\p{Ll}+", "a", regex.sub(r"\p{Lu}+", "A", re.sub("[0-9]+", "9", hit)))
    edge = regex.sub(r"[\x20\x09-\x0D]", " ", regex.sub(r"[\p{L}\p{N}]", "w", f"{before[-1:]}|{behind[:1]}"))
    return [(i, kind, v) for i, v in enumerate([near[-1], near[-2], (words(behind) or [""])[0], shape, min(len(hit) // 4, 10), edge])]


def judged(docs):
    """(doc_id, four counts, digest of the base, all spans, number of spans the method added) per document."""
    rows = []
    for n, (_, text) in enumerate(docs):
        text, own = text or "", base(text)
        for kind in range(len(P.KINDS)):
            last = 0
            matches = list(regex.finditer(P.PATTERNS[kind][1], text)) if kind >= 4 else None
            every = [m.span() for m in matches] if matches is not None else [
                m.span() for m in re.finditer([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                               r"[0-9]([\x20-]?[0-9]){15,}", r"\+[0-9][\x20().0-9-]+[0-9]"][kind], text)]
            for j, (a, b) in enumerate(every):
                gap, after = text[last:a], text[b : every[j + 1][0] if j + 1 < len(every) else len(text)]
                last = b
                if kind < 4 and (kind, a, b) not in own or kind >= 4 and any(a < y and x < b for _, x, y in own):
                    continue
                before, behind = gap[-40:], after[:24]
                rows.append((n, kind, a, b, vote(kind, text[a:b], before, behind), shapes(kind, text[a:b], before, behind)))
    post = P.estimate([(k, v, c) for (k, v), c in Counter((r[1], r[4]) for r in rows).items()])
    private, other, by_p, by_o = defaultdict(float), defaultdict(float), defaultdict(float), defaultdict(float)
    for _, kind, _, _, v, fs in rows:
        p = post[kind, v] / P.ONE
        private[kind] += p
        other[kind] += 1 - p
        for f in fs:
            by_p[f] += p
            by_o[f] += 1 - p
    kept = defaultdict(list)
    for n, kind, a, b, _, fs in rows:
        s = (private[kind] + 1) / (private[kind] + other[kind] + 2)
        prior = math.log(s / (1 - s))
        odds = prior + sum(math.log((by_p[f] + P.HELD * s) / (by_o[f] + P.HELD * (1 - s))) - prior for f in fs)
        if kind < 4 or odds > 0:
            kept[n].append((kind, a, b))
    out = []
    for n, (doc, text) in enumerate(docs):
        c = Counter(k for k, *_ in kept[n])
        digest = hashlib.sha256(joined(base(text)).encode()).hexdigest()
        out.append((doc, c[0], c[1], c[2], c[3], digest, joined(kept[n]), sum(c[k] for k in range(4, len(P.KINDS)))))
    return out
