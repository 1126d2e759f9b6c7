"""Plain versions of what the text operators compute."""

import bisect
import collections
import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def size_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def match_words(text):
    return WORD.findall((text or "").translate(UPPER))


def contaminated(docs, items):
    """(doc_id, text) and (item_id, text) as {doc_id: (n_words, n_hit, items)}."""
    windows = collections.defaultdict(set)
    for ident, text in items:
        w = match_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(ident))
    lengths = {len(k) for k in windows}
    out = {}
    for ident, text in docs:
        w, hit, found = match_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if own := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out[ident] = (len(w), len(hit), sorted(found))
    return out


def near_classes(docs, least=0.8):
    """(doc_id, text) as {doc_id: smallest doc_id of its class}: equal words, or labelled five-word shingles of similarity least."""
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    first, shingles = {}, {}
    for d, text in docs:
        w = tuple(WORD.findall((text or "").lower()))
        key = w or ("\n", text or "")
        if key in first:
            join(d, first[key])
            continue
        first[key] = d
        if w:
            seen = collections.Counter()
            own = set()
            for i in range(max(1, len(w) - 4)):
                own.add((w[i : i + 5], seen[w[i : i + 5]]))
                seen[w[i : i + 5]] += 1
            shingles[d] = own
    known = list(shingles.items())
    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            both = len(x & y)
            if both and both / (len(x) + len(y) - both) >= least:
                join(a, b)
    return {d: root(d) for d, _ in docs}


def labelled(text):
    """Five-word shingles in order, each with how often it has come before."""
    w, seen, out = tuple(WORD.findall((text or "").lower())), collections.Counter(), []
    for i in range(max(1, len(w) - 4) if w else 0):
        out.append((w[i : i + 5], seen[w[i : i + 5]]))
        seen[w[i : i + 5]] += 1
    return out


def aligned(a, b):
    """The longest common subsequence of two texts' labelled shingles over those that either has."""
    x, place = labelled(a), {s: i for i, s in enumerate(labelled(b))}
    ends = []
    for s in x:
        if s in place:
            at = bisect.bisect_left(ends, place[s])
            ends[at : at + 1] = [place[s]]
    return len(ends) / (len(x) + len(place) - len(ends)) if x and place else 0.0


def near_links(docs, least=0.8):
    """(doc_id, text) as {doc_id: (class, number of different texts of aligned similarity least)}: all pairs."""
    words = {d: tuple(WORD.findall((t or "").lower())) or ("\n", t or "") for d, t in docs}
    texts = {}
    for d, t in docs:
        texts.setdefault(words[d], (d, t))
    reps = list(texts.values())
    near = {d: set() for d, _ in reps}
    for i, (a, x) in enumerate(reps):
        for b, y in reps[:i]:
            if aligned(x, y) >= least - 1e-9:
                near[a].add(b)
                near[b].add(a)
    classes = {}
    for d in sorted(near):
        todo = [d]
        while todo:
            e = todo.pop()
            if e not in classes:
                classes[e] = d
                todo += near[e]
    smallest = {}
    for d, _ in docs:
        c = classes[texts[words[d]][0]]
        smallest[c] = min(smallest.get(c, d), d)
    return {d: (smallest[classes[texts[words[d]][0]]], len(near[texts[words[d]][0]])) for d, _ in docs}


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def proposals(text):
    """Each kind's proposals (start, end, kind, found) by the patterns of the operator's generators."""
    from tidemark.llm import pii as own

    return [(m.start(), m.end(), k, m[0]) for k in own.PROPOSED for m in re.finditer(own.WIDE[k], text or "")]


def plausible(kind, found):
    """Whether a proposal, normalised, passes its kind's check."""
    from tidemark.llm import pii as own

    digits = re.sub("[^0-9]", "", found)
    if kind == "email":
        x = re.sub(r" ?[\(\[]at[\)\]] ?", "@", found.lower())
        x = re.sub(r" ?[\(\[]dot[\)\]] ?", ".", x).replace(" ", "").rsplit("@", 1)[-1]
        return "." in x and ".." not in x and bool(re.fullmatch("[a-z]{2,24}", x.rsplit(".", 1)[-1]))
    if kind == "ip":
        return all(int(x) <= 255 for x in re.sub(r"[\[\] ]", "", found).split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        x = digits.removeprefix("00")
        return 10 <= len(x) <= 15 and (bool(re.search(own.CALLING_CODES, x)) or len(x) == 10)
    return "0a0a0a0a" in re.sub("[^0a]", "", re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "0", found)))


def features(text, start, end, kind, found):
    """The features of a proposal."""
    from tidemark.llm import pii as own

    near = lambda c: 0 if not c or c.isspace() else 1 if re.match(r"[^\W_]", c) else 2
    has = [x in found for x in (" ", "-", ".", "(")]
    before = text[max(0, start - 24) : start]
    context = lambda k: re.search(own.CONTEXT[k], before, re.IGNORECASE)
    return {
        "kind": own.PROPOSED.index(kind), "length": sum(len(found) > e for e in (8, 12, 16, 20, 32)), "signs": 5 if sum(has) > 1 else has.index(True) + 1 if any(has) else 0, "groups": min(len(re.split("[^A-Za-z0-9]+", found)) - 1, 4),
        "spelt": int(bool(re.search(r"(?i)[\(\[](?:at|dot|\.)[\)\]]| [.@]|@ ", found))), "prefix": 1 if re.match(r"\+|00", found) else 2 if found[0] == "(" else 0,
        "before": near(text[start - 1 : start] if start else ""), "after": near(text[end : end + 1]), "context": 2 if context(kind) else 1 if any(context(k) for k in own.PROPOSED if k != kind) else 0,
    }


def added(text, trees):
    """Accepted proposals that overlap no base span, the earliest and then the longest of those that overlap: kind:start:end."""
    from math import exp

    from tidemark.llm import pii as own

    text = text or ""
    base = [tuple(map(int, x.split(":")[1:])) for x in pii(text).split(",") if x]
    value = lambda tree, f: tree if isinstance(tree, float) else value(tree[2] if f[tree[0]] <= tree[1] else tree[3], f)
    out, reached = [], 0
    for a, b, kind, found in sorted(proposals(text), key=lambda x: (x[0], -x[1], own.PROPOSED.index(x[2]))):
        f = features(text, a, b, kind, found)
        if a < reached or any(x < b and a < y for x, y in base) or not plausible(kind, found):
            continue
        score = 1 / (1 + exp(-(trees.prior + sum(value(t, f) for t in trees.trees))))
        if score >= trees.thresholds[f["kind"]]:
            out.append(f"{kind}:{a}:{b}")
            reached = b
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii(text):
    """kind:start:end of the base rules, by start."""
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def targets(sizes, weights=(5, 2, 1)):
    """{source: size} as {source: target}: the excess over 3 times a size is shared again until none is left."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return full | share
        for s in over:
            full[s] = 3.0 * sizes[s]
            left -= full[s]
        free -= over
    return full
