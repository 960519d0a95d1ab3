"""Plain versions of the operators' results, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def base_failed(s):
    return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]


def shingles(text, n=5):
    w = tuple(words(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    if 0 < len(w) < n:
        return {w}
    return {w[k : k + n] for k in range(len(w) - n + 1)}


def link(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 75 * (len(a) + len(b) - common)


def components(rows):
    """{row number: smallest id of its component} for (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if link(sets[i], sets[j]):
                group[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            smallest[r] = min(doc_id, smallest.get(r, doc_id))
    return {i: smallest.get(find(i)) for i in range(len(rows))}, [len(s) for s in sets]


def without_repeats(rows, window=35):
    """Per row (n_words, n_removed, sha256 of the kept words)."""
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for j in range(k, k + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def license_base(text, phrases):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        at = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secret_spans(text):
    text = text or ""
    out = []
    keys = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    for m in re.finditer(keys + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def crc(text):
    return zlib.crc32((text or "").encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merkle(rows):
    """The rows of the manifest for (doc_id, source, lang, n_chars, text) rows."""

    def digest(*parts):
        return sha("".join(parts).encode())

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
        return out

    def path(tree, at):
        for nodes in tree[:-1]:
            first = at // 16 * 16
            run = nodes[first : first + 16]
            yield run[: at - first], run[at - first + 1 :]
            at //= 16

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, digest(*map(framed, row)), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(groups[s], key=lambda x: x[:3]) for s in names}
    trees = {s: levels([leaf for _, _, leaf, _ in groups[s]]) for s in names}
    crown = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(groups[s]):
            node, own = leaf, [*path(trees[s], i), *path(crown, k)]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                low = row[4] and re.sub("[A-Z]", lambda m: m[0].lower(), row[4])
                node = digest(*map(framed, (*row[:4], low)))
            for before, after in own:
                node = digest(*before, node, *after)
            proof = digest(*(x for before, after in own for x in before + after))
            out.append((row[0], leaf, trees[s][-1][0], crown[-1][0], proof, node, node == crown[-1][0]))
    return out


def runs(w):
    """All maximal stretches of smallest period q, of max(6, 4 q) words or more."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            u = w[i : j + q]
            if len(u) >= max(6, 4 * q) and not any(u[r:] == u[: len(u) - r] for r in range(1, q)):
                out.append((i, len(u), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, text):
    """The row of the run report of one document."""
    w = words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    first = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *first, sha(listed.encode()), sha(kept.encode()))
