"""Brute-force versions shared by the tests of this folder."""

import collections
import hashlib
import re
from bisect import bisect_left

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def near_classes(rows, least=0.8):
    """Brute force: labelled five-word shingles, order-keeping overlap, connected components; id -> smallest id."""
    texts = sorted({tuple(words(t)) for _, t in rows})
    labels, places, parent = [], collections.defaultdict(list), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, w in enumerate(texts):
        seen, own = collections.Counter(), {}
        for p, s in enumerate([w[i:i + 5] for i in range(len(w) - 4)] if len(w) > 4 else [w] if w else []):
            own[s, seen[s]] = p
            seen[s] += 1
        labels.append(own)
        overlap = collections.Counter(q for s in own for q in places[s])
        for q in overlap:
            tails = []
            for p in (labels[q][s] for s in sorted(own, key=own.get) if s in labels[q]):
                at = bisect_left(tails, p)
                tails[at:at + 1] = [p]
            if len(tails) / (len(own) + len(labels[q]) - len(tails)) >= least:
                parent[root(k)] = root(q)
        for s in own:
            places[s].append(k)
    where = {w: root(k) for k, w in enumerate(texts)}
    smallest = {}
    for i, t in rows:
        c = where[tuple(words(t))]
        smallest[c] = min(smallest.get(c, i), i)
    return {i: smallest[where[tuple(words(t))]] for i, t in rows}


def base_spans(text):
    """Brute force for the fixed patterns: (start, kind, end)."""
    text = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[0], order.index(s[1]), s[2]))


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
