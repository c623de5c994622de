"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, label string, _kept string, _scan string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs_frame(spark, rows):
    """Documents (id, text, lang) with further columns whose names clash with names that operators use."""
    full = [(i, t, lang, "s", len(t or ""), 1.0, 1, "x", "k", None) for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def prose(seed, n=80):
    """Deterministic words that differ by seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("".join(chr(97 + (x >> s) % 26) for s in (3, 8, 13, 18))[: 2 + x % 3])
    return " ".join(out)


def edge_rows():
    """Null and empty texts, null and repeated ids, repeated rows, ties and a very long text."""
    a, b = prose(1), prose(2)
    return [
        (1, a, "en"),
        (2, None, None),
        (3, "", "en"),
        (4, " \n\t!?", "fr"),
        (5, b, "en"),
        (5, b, "en"),
        (5, a + " tail", "de"),
        (None, b + " more", None),
        (None, None, None),
        (7, prose(3, 60_000), "en"),
        (8, "one", "en"),
        (9, "one", None),
        (10, "Ünïcode ßtraße 中文 😀 naïve", "de"),
    ]


def groups(rows, n=5, parts=8, whole=10):
    """(class id, links) of each row: Jaccard of word n-grams at least parts / whole."""
    sets = []
    for _, text, *_ in rows:
        w = words(text)
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and whole * both >= parts * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i, (key, *_) in enumerate(rows):
        members[find(i)].append(key)
    least = {r: min((k for k in m if k is not None), default=None) for r, m in members.items()}
    return [(least[find(i)] if sets[i] else rows[i][0], links[i]) for i in range(len(rows))]


def contamination(rows, items, window=10):
    """(words, hit words, sorted item ids) of each row."""
    out = []
    for _, text in rows:
        w, hit, found = words(text), set(), set()
        for key, other in items:
            o = words(other)
            if key is None or not o:
                continue
            size = min(window, len(o))
            wanted = {tuple(o[k : k + size]) for k in range(len(o) - size + 1)}
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in wanted:
                    hit |= set(range(k, k + size))
                    found.add(str(key))
        out.append((len(w), len(hit), sorted(found)))
    return out


def rebuilt(turns):
    """Rebuilt conversations {conv: [(role, text)]} from rows (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda y: y[0])] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100
        out[c] = own.get(base, [])[:h] + own[c][h:]
    return out


def trie(turns):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node, sorted."""
    whole = rebuilt(turns)
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(m) - 1) * (len(path[-1][1]) if path else 0)
    found = [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(p)))).encode()).hexdigest())
        for p, m in members.items()
    ]
    return sorted(found, key=lambda r: r[:2])


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, fan=16):
    """Rows of op12 for documents (doc_id, text, lang, source, n_chars), as a sorted list."""

    def leaf(d, text):
        return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d[0], d[3], d[2], d[4], text)))

    def climb(nodes):
        """Levels of a tree, from its leaves to the top."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([_h(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def siblings(levels, at):
        for level in levels[:-1]:
            first = at - at % fan
            yield level[first:at], level[at + 1 : first + fan]
            at //= fan

    groups = defaultdict(list)
    for d in rows:
        groups[(d[3] is not None, (d[3] or "").encode())].append(d)
    groups = {k: sorted(groups[k], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d, d[1]))) for k in sorted(groups)}
    trees = [climb([leaf(d, d[1]) for d in g]) for g in groups.values()]
    over = climb([t[-1][0] for t in trees])
    out = []
    for i, (group, tree) in enumerate(zip(groups.values(), trees, strict=True)):
        for j, d in enumerate(group):
            path = [*siblings(tree, j), *siblings(over, i)]
            changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 and d[1] is not None
            fold = leaf(d, d[1].translate(LOWER) if changed else d[1])
            for left, right in path:
                fold = _h(*left, fold, *right)
            root = over[-1][0]
            out.append((d[0], tree[0][j], tree[-1][0], root, _h(*(x for left, right in path for x in left + right)), fold, fold == root))
    return sorted(out, key=repr)


def exact(rows):
    """(doc_id, keep_id, group_size, kept, digest) of each document (doc_id, text), as a sorted list."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out += [(i, ids[0], len(ids), k == 0, _h(text)) for k, i in enumerate(ids)]
    return sorted(out, key=repr)
