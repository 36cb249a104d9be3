"""Plain versions of the operators' contracts, and a small table with every awkward case."""

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row long, key long, kind string, start long, copy boolean"


def sha(b) -> str:
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def documents(seed: int = 5) -> list[tuple]:
    """(doc_id, text) rows: nulls, empties, copies, near copies, shared passages, repeats inside a text, one very long text."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnoprstué") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(60)
    rows = [(i, prose(rng.randint(1, 120))) for i in range(30)]
    base = prose(150).split(" ")
    rows.append((30, " ".join(base)))
    for i in range(31, 45):
        near = list(base)
        for _ in range(rng.randint(0, 2)):
            near[rng.randrange(len(near))] = rng.choice(words)
        rows.append((i, " ".join(near)))
    rows += [(i, prose(20) + "\n" + passage + "\t" + prose(20)) for i in range(45, 55)]
    rows += [(55, None), (56, ""), (57, "   "), (58, None), (59, "one"), (60, "One Two"), (61, "one two"), (62, "\u00a0x\u2028y z"), (63, "日本 語 " * 40)]
    rows += [(64, (prose(30) + " ") * 4), (65, prose(9000)), (66, rows[3][1]), (67, rows[3][1]), (3, rows[3][1]), (68, "a" * 5000), (69, "b c" * 700)]
    rows += [(70, "Mail a.b@c-d.example.org, +1 (212) 555-0199; 4111 1111 1111 1111 or 1.2.3.4, 300.1.1.1 and 12.13.14.15.16.17.18.19"), (71, "x@y.z_d@e.f 4111111111111112 +12 34 é +1234567890123456")]
    rows += [(72, 'token = "0123456789abcdef0123456789abcdef01234567" card 378282246310005'), (None, "a row without an id " * 8), (None, None)]
    return rows


def full(rows) -> list[tuple]:
    return [(i, t, "en", "src0", None if t is None else len(t), 1, 2, "email", 3, True) for i, t in rows]


def words_of(text) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def repeats(rows, width: int, words: bool) -> dict:
    """(doc_id, text) → (units, removed, removed runs, what stays) by the first start of each window."""
    cut = words_of if words else (lambda t: (t or "").encode())
    first: dict = {}
    ids = sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: (r[0], r[1] or ""))
    for i, t in ids:
        u = cut(t)
        for k in range(len(u) - width + 1):
            w = tuple(u[k : k + width]) if words else u[k : k + width]
            first.setdefault(w, (i, k))
    out = {}
    for i, t in {(i, t) for i, t in rows}:
        u = cut(t)
        gone = [False] * len(u)
        for k in range(len(u) - width + 1) if i is not None else ():
            if first[tuple(u[k : k + width]) if words else u[k : k + width]] < (i, k):
                gone[k : k + width] = [True] * width
        stay = [x for x, g in zip(u, gone) if not g]
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i, t] = (len(u), sum(gone), runs, " ".join(stay) if words else bytes(stay))
    return out


def shingles(text, n: int = 3) -> set:
    w = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return set(zip(*[w[k:] for k in range(n)])) if len(w) >= n else ({tuple(w)} if w else set())


def groups(pairs, nodes) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_groups(rows, num: int = 90, den: int = 100, n: int = 3) -> dict:
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t, n))
    pairs = [(a, b) for a in sets for b in sets if a < b for x in sets[a] for y in sets[b] if x and den * len(x & y) >= num * len(x | y)]
    return groups(pairs, sets)
