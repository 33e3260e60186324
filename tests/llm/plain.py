"""Plain Python versions of the operators, for small inputs."""

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

ASCII = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def hits(text, items, window=10):
    """Hit word numbers of a text and the items that hit it."""
    words, hit, found = alphanumeric(text), set(), set()
    for item, content in items:
        own = alphanumeric(content)
        for s in range(max(1, len(own) - window + 1) if own else 0):
            win = own[s : s + window]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.update([] if item is None else [str(item)])
    return sorted(hit), sorted(found)


def without_repeated_lines(docs):
    """{(id, text): kept text}; a null id is the largest."""
    def rank(i, text, s):
        return (i is None, i or 0, s)

    first = {}
    for i, text in docs:
        cut = text.split("\n") if text is not None else []
        for s in range(len(cut) - 2):
            key = tuple(cut[s : s + 3])
            first[key] = min(first.get(key, (True, math.inf, 0)), rank(i, text, s))
    out = {}
    for i, text in docs:
        cut = text.split("\n") if text is not None else []
        gone = set()
        for s in range(len(cut) - 2):
            if rank(i, text, s) > first[tuple(cut[s : s + 3])]:
                gone.update(range(s, s + 3))
        out[i, text] = text if text is None else "\n".join(
            x for n, x in enumerate(cut) if n not in gone
        )
    return out


def shingles(text, n):
    words = [w.translate(ASCII) for w in spaced(text)]
    return {tuple(words[s : s + n]) for s in range(max(1, len(words) - n + 1))} if words else set()


def linked(docs, n=4, percent=85):
    """{id: smallest id reached}, of documents with an id."""
    sets = [(i, shingles(t, n)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def link_counts(docs, n=4, percent=85):
    """Sorted (id, number of other rows linked), over rows with an id; null without one."""
    sets = [(i, shingles(t, n)) for i, t in docs]
    out = []
    for k, (i, a) in enumerate(sets):
        if i is None:
            continue
        out.append((i, sum(
            1 for j, (other, b) in enumerate(sets)
            if j != k and other is not None and a and b
            and 100 * len(a & b) >= percent * len(a | b)
        )))
    return sorted(out)


def without_repeats(docs, n=13):
    """{(id, text): (kept words, removed)}; a null id is the largest."""
    first = {}
    for i, text in docs:
        words = spaced(text)
        for s in range(len(words) - n + 1):
            key = tuple(words[s : s + n])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = {}
    for i, text in docs:
        words, gone = spaced(text), set()
        for s in range(len(words) - n + 1):
            if first[tuple(words[s : s + n])] < (math.inf if i is None else i):
                gone.update(range(s, s + n))
        out[i, text] = " ".join(w for p, w in enumerate(words) if p not in gone), len(gone)
    return out


class Katz:
    """The model of plain counts; ``discounts`` maps counts of counts to discounts."""

    def __init__(self, texts, discounts, top, order=3):
        self.order, self.top = order, top
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for tokens in map(self.tokens, texts):
            for i in range(order - 1, len(tokens)):
                for k in self.counts:
                    self.counts[k][tuple(tokens[i - k + 1 : i + 1])] += 1
        self.one = Counter({w: n for (w,), n in self.counts[1].items()})
        self.total = sum(self.one.values())
        self.d = {k: discounts(self.ofs(c)) for k, c in self.counts.items()}
        self.after = defaultdict(list)
        for k in range(2, order + 1):
            for gram, n in self.counts[k].items():
                self.after[gram[:-1]].append((gram[-1], n))
        freed = sum(n * (1 - self.d[1][min(n, top)]) for n in self.one.values())
        self.unknown = (freed or 1) / (self.total + (0 if freed else 1)) if self.total else 1.0
        self.share = 1.0 if freed else self.total / (self.total + 1)
        self.known = {}

    def ofs(self, counts):
        import numpy as np

        of = Counter(counts.values())
        return np.array([0, *(of[r] for r in range(1, self.top + 1))])

    def tokens(self, text):
        return ["<begin>"] * (self.order - 1) + spaced((text or "").translate(ASCII)) + ["<end> "]

    def word(self, w):
        n = self.one[w]
        return self.share * self.d[1][min(n, self.top)] * n / self.total if n else self.unknown

    def given(self, context):
        """Probabilities kept for the words seen after a context, and its backoff weight."""
        if context not in self.known:
            seen = self.after[context]
            total, d = sum(n for _, n in seen), self.d[len(context) + 1]
            kept = {w: d[min(n, self.top)] * n / total for w, n in seen}
            left = 1 - sum(kept.values())
            if left < 1e-12:
                kept = {w: p * total / (total + 1) for w, p in kept.items()}
                left = 1 / (total + 1)
            shorter = sum(self.probability(context[1:], w) for w in kept)
            self.known[context] = kept, left / (1 - shorter)
        return self.known[context]

    def probability(self, context, w):
        if not context:
            return self.word(w)
        if context not in self.after:
            return self.probability(context[1:], w)
        kept, backoff = self.given(context)
        return kept.get(w) or backoff * self.probability(context[1:], w)

    def score(self, text):
        t, n = self.tokens(text), self.order
        return sum(math.log10(self.probability(tuple(t[i - n + 1 : i]), t[i])) for i in range(n - 1, len(t)))


def aligned(docs, a, b, spell_a, spell_b):
    """[(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)] of whole texts.
    ``a`` and ``b`` encode a text, ``spell_a`` and ``spell_b`` give a token's bytes."""
    texts, links = [], Counter()
    for i, text in docs:
        want = (" " + (text or "")).encode()
        ids_a, ids_b = (a(" " + text), b(text)) if text else ([], [])
        spelt = [[f(t) for t in ids] for f, ids in ((spell_a, ids_a), (spell_b, ids_b))]
        if any(b"".join(s) != want for s in spelt):
            ids_a = ids_b = []
            spelt = [[], []]
        ends = [list(accumulate(map(len, s))) for s in spelt]
        own = [(ids_a[x], ids_b[y]) for x, e in enumerate(ends[0]) for y in [index(ends[1], e)] if y is not None]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [
            [ids[bisect_right(end, low) : bisect_right(end, high)] for ids, end in zip((ids_a, ids_b), ends)]
            for low, high in zip([0, *cuts], cuts)
        ]
        texts.append((i, ids_a, ids_b, groups, own))
        links.update(own)
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return [
        (
            i, len(ids_a), len(ids_b), len(groups), len(own),
            sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own),
            ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups),
        )
        for i, ids_a, ids_b, groups, own in texts
    ]


def index(values, value):
    at = bisect_left(values, value)
    return at if at < len(values) and values[at] == value else None


def rule_of(url, rules):
    """Host, path and the longest fitting rule of an address."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate(ASCII)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return host, path, max(fits, key=lambda r: len(r[0] + r[1]), default=None) if rest else None


def verdicts(urls, rules, links):
    """Verdicts of ``urls``; ``links`` are pairs of addresses."""
    def node(url):
        head = re.match("(?s).*?://[^/?#]*", url)[0]
        return head.translate(ASCII) + url[len(head) :].split("#")[0]

    reach = defaultdict(set)
    for a, b in links:
        reach[node(a)].add(node(b))
        reach[node(b)].add(node(a))
    blocked = {
        node(u)
        for u in [*urls, *(u for pair in links for u in pair)]
        if u and "://" in u and (rule_of(u, rules)[2] or " ")[-1] == "block" and node(u) in reach
    }
    todo = list(blocked)
    while todo:
        for other in reach[todo.pop()] - blocked:
            blocked.add(other)
            todo.append(other)
    out = []
    for url in urls:
        rule = rule_of(url, rules)[2]
        alias = url is not None and "://" in url and node(url) in blocked
        out.append(rule[2] if rule else "block" if alias else "allow")
    return out


def divergence(docs, least, top):
    """Rows of the audit of (lang, source, text)."""
    docs = [tuple(v or "" for v in d) for d in docs]
    found = [(lang, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(ASCII))) for lang, s, t in docs]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(w for other, _, words in found if other == lang for w in set(words))
        kept = sorted(w for w, n in seen.items() if n >= least)
        counts = {s: Counter() for other, s, _ in docs if other == lang}
        for other, s, words in found:
            if other == lang:
                counts[s].update(w for w in words if w in set(kept))

        def shares(c):
            n, v = sum(c.values()), len(kept)
            return {w: 1 + 10**9 * (c[w] + 5) // (n + 5 * v) for w in kept}

        usual = shares(sum(counts.values(), Counter()))
        own = {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(sum(abs(own[s][w] - own[o][w]) for w in kept), o) for o in counts if o != s]
            terms = [(own[s][w] - usual[w], w) for w in kept if counts[s][w] and own[s][w] > usual[w]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                ranked = [(lang, s, part, item, value, r) for r, (value, item) in enumerate(items, 1)]
                out += ranked if part == "pair" else ranked[:top]
    return out
