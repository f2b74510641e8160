"""Plain-Python versions of the training-data operators, written from their definitions."""

import hashlib
import itertools
import math
import re
import string
from collections import Counter, defaultdict
from html.parser import HTMLParser

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return set(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    """{(doc_id, n_shingles, component_id)} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [(d, len(sets[i]), min(low[find(i)], default=None) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def leaks(docs, items):
    out = set()
    for (d, text), (i, item) in itertools.product(set(docs), set(items)):
        want = shingles(item)
        got = len(want & shingles(text))
        if want and 10 * got >= 8 * len(want):
            out.add((d, i, len(want), got))
    return out


def repeated_strings(rows, length=400):
    """{(doc_id, n_bytes, n_removed, n_spans, kept_sha256)} of (doc_id, text) rows."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def line_pairs(text):
    """Numbers of every two neighbouring lines with text."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip(" \t\r\v\f")]
    return lines, list(zip(full, full[1:]))


def dedup_lines(rows):
    """Texts, in order, of (doc_id, text) rows."""
    places = defaultdict(set)
    for d, text in rows:
        lines, pairs = line_pairs(text or "")
        for a, b in pairs:
            places[lines[a], lines[b]].add((d is None, d or 0, text, a))
    out = []
    for d, text in rows:
        lines, pairs = line_pairs(text or "")
        gone = set()
        for a, b in pairs:
            if min(places[lines[a], lines[b]]) != (d is None, d or 0, text, a):
                gone |= set(range(a, b + 1))
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if text else text)
    return out


class PPM:
    """Frozen-count PPM, method C, with exclusion."""

    def __init__(self, texts, order=3):
        self.order, self.counts = order, {}
        for lang, docs in texts.items():
            c = self.counts[lang] = defaultdict(Counter)
            for d in docs:
                for i in range(len(d)):
                    for m in range(min(order, i) + 1):
                        c[d[i - m:i]][d[i]] += 1
        self.known = {x for c in self.counts.values() for x in c}

    def bits(self, data, lang):
        total = 0.0
        for i, b in enumerate(data):
            m = max(m for m in range(min(self.order, i) + 1) if data[i - m:i] in self.known)
            out = set()
            for j in range(m, -1, -1):
                row = {x: n for x, n in self.counts[lang].get(data[i - j:i], {}).items() if x not in out}
                n, d = sum(row.values()), len(row)
                if b in row:
                    total += math.log2((n + d) / row[b])
                    break
                if n:
                    total += math.log2((n + d) / d)
                out |= set(row)
            else:
                total += math.log2(256 - len(out))
        return total


def step_cost(role, before, after):
    """Cost of taking a turn from one state to the next (0 start, 1 system, 2 user, 3 assistant); None: no way."""
    new = {(0, 1): 0, (0, 2): 0, (1, 2): 0, (3, 2): 0, (2, 3): 0, (2, 2): 1, (0, 3): 1, (1, 3): 1, (3, 3): 1}.get((before, after))
    change = 3 * (role != after)
    ways = ([change + 4 * new] if new is not None else []) + ([change + 2] if before == after else [])
    return min(ways, default=None)


def repair_states(roles):
    """The states of the best repair: least cost, then smallest states from the last turn backwards."""
    kinds = [{"system": 1, "user": 2, "assistant": 3}.get(r, 0) for r in roles]
    best = None
    for path in itertools.product((1, 2, 3), repeat=len(roles)):
        costs = [step_cost(k, a, b) for k, a, b in zip(kinds, (0, *path), path)]
        if None not in costs:
            cost = sum(costs) + 4 * {1: 2, 2: 1, 3: 0}[path[-1]]
            best = min(best or (1 << 30,), (cost, path[::-1]))
    return best[0], best[1][::-1]


class Tree(HTMLParser):
    """A page with all its end tags as nested [tag, class, children]; text is a str among the children."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.root = ["html", "", []]
        self.open = [self.root]
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag != "html":
            node = [tag, dict(attrs).get("class", ""), []]
            self.open[-1][2].append(node)
            if tag != "br":
                self.open.append(node)

    def handle_endtag(self, tag):
        if tag != "html":
            assert self.open.pop()[0] == tag

    def handle_data(self, data):
        self.open[-1][2].append(data)


def main_text(source, cut_tags, cut_names, blocks):
    """The article of a page with all its end tags and one ``body``: every count walks its whole subtree anew."""
    root = Tree(source).root

    def prune(node):
        node[2] = [c if isinstance(c, str) else prune(c) for c in node[2] if isinstance(c, str) or not (c[0] in cut_tags or c[1] in cut_names)]
        return node

    def nodes(node):
        yield node
        for c in node[2]:
            if not isinstance(c, str):
                yield from nodes(c)

    def chars(node, tag=None, found=False):
        """Characters under the elements of ``tag`` (all without one)."""
        found = found or tag is None or node[0] in tag
        return sum(len("".join(c.split())) * found if isinstance(c, str) else chars(c, tag, found) for c in node[2])

    prune(root)
    body = next(n for n in nodes(root) if n[0] == "body")
    links = ("a",)
    heads = ("h1", "h2", "h3", "h4", "h5", "h6")

    def density(node):
        c = chars(node)
        if not c:
            return 0.0
        lc, t, lt = chars(node, links), sum(1 for _ in nodes(node)), sum(n[0] == "a" for n in nodes(node))
        base = math.log(c / max(c - lc, 1) * lc + chars(body, links) / max(chars(body), 1) * c + math.e)
        return c / t * max(math.log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / base

    def total(node):
        return sum(density(c) for c in reversed(node[2]) if not isinstance(c, str))

    def way(node, goal):
        if node is goal:
            return [node]
        for c in node[2]:
            if not isinstance(c, str) and (rest := way(c, goal)):
                return [node, *rest]
        return []

    every = list(nodes(body))
    sums = [total(n) for n in every]
    core = every[sums.index(max(sums))]
    path = way(body, core)
    top = next((n for n in path if density(n) >= density(core) > 0 or n is not body and n[0] in ("article", "main")), core)
    least = min(map(density, path))
    taken = [top]
    for above, below in zip(path[:[n is top for n in path].index(True)], path[1:]):
        children = [c for c in above[2] if not isinstance(c, str) and chars(c)]
        only_head = [c is not below and chars(c, heads) == chars(c) for c in children]
        belongs = [c is below or least > 0 and (density(c) >= least or 2 * chars(c, links) < chars(c) and total(c) >= least) for c in children]
        for k, c in enumerate(children):
            if only_head[k]:  # headings in a row go with what follows, up to the next heading
                after = k
                while after < len(children) and only_head[after]:
                    after += 1
                while after < len(children) and not only_head[after]:
                    if belongs[after]:
                        taken.append(c)
                        break
                    after += 1
            elif c is not below and belongs[k]:
                taken.append(c)
    out = [""]

    def write(node, inside):
        inside = inside or any(node is n for n in taken)
        for c in node[2]:
            if isinstance(c, str):
                out[-1] += c * inside
            elif c[0] == "br":
                out[-1] += " " * inside
            else:
                if c[0] in blocks:
                    out.append("")
                write(c, inside)
                if c[0] in blocks:
                    out.append("")

    write(root, False)
    return "\n".join(b for b in (" ".join(b.split()) for b in out) if b)


def segmentations(text, scores, byte_ids, byte_score):
    """All (score, ids) paths of an escaped word, best first."""
    out = [(0.0, ())] if not text else []
    for n in range(1, len(text) + 1):
        heads = []
        if text[:n] in scores:
            heads.append((scores[text[:n]][0], (scores[text[:n]][1],)))
        elif n == 1:
            raw = text[0].encode()
            heads.append((byte_score * len(raw), tuple(byte_ids[b] for b in raw)))
        for s, ids in heads:
            out += [(s + t, ids + rest) for t, rest in segmentations(text[n:], scores, byte_ids, byte_score)]
    return sorted(out, key=lambda x: -x[0])


def best_scores(text, scores, byte_ids, byte_score, n):
    """{score: [number of paths, their lengths]} of the n greatest scores over all paths of a whole escaped text."""
    at = [{0.0: [1, {0}]}]
    for end in range(1, len(text) + 1):
        here = {}
        for start in range(end):
            piece = text[start:end]
            if piece in scores:
                step, pieces = scores[piece][0], 1
            elif len(piece) == 1:
                pieces = len(("▁" if piece == "\0" else piece).encode())
                step = byte_score * pieces
            else:
                continue
            for score, (count, lengths) in at[start].items():
                got = here.setdefault(score + step, [0, set()])
                got[0] += count
                got[1] |= {k + pieces for k in lengths}
        at.append(dict(sorted(here.items(), reverse=True)[:n]))
    return at[-1]


def bucket_of(feature, buckets):
    crc = 0xFFFFFFFF
    for byte in feature.encode():
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0xEDB88320 * (crc & 1))
    return (crc ^ 0xFFFFFFFF) % buckets


def resampled(rows, target, most=1, buckets=10_000, percent=10, least=20, seed=2024):
    """Sorted (doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    def cut(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(w), [bucket_of(" ".join(w[i:i + n]), buckets) for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    parts = [cut(t) for _, t in rows]
    s, t = Counter(b for _, p in parts for b in p), Counter(b for x in target for b in cut(x)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t)))
    out = []
    for (d, _), (n, p) in zip(rows, parts):
        weight = sum(map(gain, p)) // len(p) if p else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(p), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for rank, x in enumerate(able[:percent * len(able) // 100], 1):
        x[4] = rank
    return sorted((tuple(x[:5]) for x in out), key=repr)


def repeated_runs(rows, window=50):
    """[(doc_id, n_words, n_removed, kept)] of (doc_id, text) rows."""
    parts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in parts:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, math.inf), math.inf if d is None else d)
    out = []
    for d, w in parts:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (math.inf if d is None else d):
                gone |= set(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out
