"""Plain versions of the operators, for small inputs."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) if w]


def shingles(text, k):
    w = words(text)
    width = min(k, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if w else frozenset()


def linked_pairs(sets, percent):
    seen = defaultdict(list)
    for a in sets:
        shared = Counter(b for g in sets[a] for b in seen[g])
        for g in sets[a]:
            seen[g].append(a)
        for b, n in shared.items():
            if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                yield a, b


def near_duplicates(rows, k, percent):
    """rows: (key, doc_id, text) -> key: (set size, component's smallest doc_id)."""
    sets = {key: shingles(text, k) for key, _, text in rows}
    ids = {key: i for key, i, _ in rows}
    union = Union()
    for a, b in linked_pairs(sets, percent):
        union.join(a, b)
    least = {}
    for key in sets:
        if ids[key] is not None:
            root = union.find(key)
            least[root] = min(least.get(root, ids[key]), ids[key])
    return {key: (len(sets[key]), least.get(union.find(key))) for key in sets}


def dedup_lines(rows, width=8, percent=80):
    """rows: (doc_id, text) -> texts, in the rows' order."""
    edge = " \t\r"
    first, places = {}, []
    for at, (i, text) in enumerate(rows):
        tie = xxhash.xxh64_intdigest((text or "").encode())
        places.append((i is None, i or 0, tie - (tie >> 63 << 64)))
        for n, line in enumerate((text or "").split("\n")):
            if bare := line.strip(edge):
                place = (*places[at], n, at)
                first[bare] = min(first.get(bare, place), place)
    sets = {q: frozenset(q[j : j + width] for j in range(max(1, len(q) - width + 1))) for q in first}
    union = Union()
    for a, b in linked_pairs(sets, percent):
        union.join(a, b)
    kept = {}
    for q, place in first.items():
        root = union.find(q)
        kept[root] = min(kept.get(root, place), place)
    out = []
    for at, (_, text) in enumerate(rows):
        if text is None:
            out.append(None)
            continue
        out.append("\n".join(line for n, line in enumerate(text.split("\n")) if not line.strip(edge) or kept[union.find(line.strip(edge))] == (*places[at], n, at)))
    return out


SECRETS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile("[0-9a-f]+"), 0, 16),
)


MORE_SECRETS = (
    ("pem", re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1),
    ("hubtoken", re.compile("gh[pousr]_[A-Za-z0-9]{36,}"), 0, 1),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
)


def secrets(text, kinds=SECRETS):
    found = sorted((m.start(), n, m.end()) for n, (_, pattern, group, least) in enumerate(kinds) for m in pattern.finditer(text or "") if len(m.group(group)) >= least)
    return ",".join(f"{kinds[n][0]}:{a}:{b}" for a, n, b in found), [sum(n == k for _, n, _ in found) for k in range(len(kinds))]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def _log_sum(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def lattice(word, pieces, log):
    """Log of the sum over a word's segmentations, and each piece's expected uses."""
    text = "▁" + word
    n = len(text)
    arcs = []
    for i in range(n):
        for j in range(i + 1, min(n, i + 20) + 1):
            if text[i:j] in pieces.numbers:
                arcs.append((i, j, [pieces.numbers[text[i:j]]]))
            elif j == i + 1:
                arcs.append((i, j, [pieces.bytes[b] for b in text[i].encode()]))
    arcs = [(i, j, used, sum(log[p] for p in used)) for i, j, used in arcs]
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    for at in range(1, n + 1):
        ahead[at] = _log_sum([ahead[i] + w for i, j, _, w in arcs if j == at])
    for at in range(n - 1, -1, -1):
        behind[at] = _log_sum([behind[j] + w for i, j, _, w in arcs if i == at])
    uses = Counter()
    for i, j, used, w in arcs:
        for p in used:
            uses[p] += math.exp(ahead[i] + w + behind[j] - ahead[n])
    return ahead[n], uses


def lattice_scores(token_lists, trained, pieces, prior):
    """token_lists: words of each document; trained: which of them are learnt from -> log10 probabilities."""
    counts = Counter(w for ws, t in zip(token_lists, trained, strict=True) if t for w in ws)
    n_docs, total = sum(trained), sum(counts.values())
    first = [math.log(p) for p in pieces.first]
    uses = Counter()
    for word, count in counts.items():
        for p, n in lattice(word, pieces, first)[1].items():
            uses[p] += n * count
    down = sum(uses.values()) + prior
    log = [math.log((uses[p] + prior * w) / down) for p, w in enumerate(pieces.first)]
    known = min(0.95, max(0.05, 1 - sum(c == 1 for c in counts.values()) / total))
    end = math.log10((n_docs + 0.5) / (total + n_docs + 0.5 * (len(counts) + 2)))

    def score(word):
        ways = [lattice(word, pieces, log)[0] + math.log(1 - known)]
        if counts[word]:
            ways.append(math.log(known * counts[word] / total))
        return _log_sum(ways) / math.log(10)

    scores = {w: score(w) for w in {w for ws in token_lists for w in ws}}
    return [sum(scores[w] for w in ws) + end for ws in token_lists]


_WORD64 = (1 << 64) - 1


def _mixed(x):
    x = (x + 0x9E3779B97F4A7C15) & _WORD64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _WORD64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _WORD64
    return x ^ x >> 31


def order_fingerprint(text, k, pick, factors, shifts):
    """Per sketch the ``pick`` smallest occurrence-numbered k-mers, in text order, hashed; hexadecimal."""
    if not text:
        return ""
    width = min(k, len(text))
    hashes, numbered, before = [], [], Counter()
    for i in range(len(text) - width + 1):
        h = width
        for c in text[i : i + width]:
            h = (h * 0x100000001B3 + ord(c)) & _WORD64
        h = _mixed(h)
        hashes.append(h)
        numbered.append(_mixed((h + before[h] * 0x9E3779B97F4A7C15) & _WORD64) >> 32)
        before[h] += 1
    out = ""
    for sketch, (a, b) in enumerate(zip(factors, shifts, strict=True), 1):
        smallest = sorted(range(len(numbered)), key=lambda i: ((numbered[i] * a + b) & 0xFFFFFFFF, i))[:pick]
        value = sketch
        for i in sorted(smallest):
            value = _mixed((value * 0xD1342543DE82EF95 + hashes[i]) & _WORD64)
        out += f"{value >> 32:08x}"
    return out


def log_mel(payload, frame=256, hop=128, mels=20, high=1.0, low=-1.0):
    """Log-mel frames and active spans of 8-bit samples at 8 kHz, resampled to 3 kHz, by their defining sums."""
    x = [(b - 128) / 128 for b in payload]
    # 30 taps of a windowed sinc at three times the rate; output n lies at input time 8n/3
    taps = [np.sinc((i - 14.5) / 8) * (0.5 - 0.5 * math.cos(2 * math.pi * (i + 1) / 31)) for i in range(30)]
    y = []
    for n in range(-(-len(x) * 3 // 8)):
        base, phase = divmod(8 * n, 3)
        own = [taps[phase + 3 * k] for k in range(10)]
        around = [x[base + 5 - k] if 0 <= base + 5 - k < len(x) else 0.0 for k in range(10)]
        y.append(sum(a * b for a, b in zip(own, around, strict=True)) / sum(own))
    while len(y) < frame or (len(y) - frame) % hop:
        y.append(0.0)
    window = [0.5 - 0.5 * math.cos(2 * math.pi * (i + 1) / (frame + 1)) for i in range(frame)]
    frames = np.array([[y[s + i] * window[i] for i in range(frame)] for s in range(0, len(y) - frame + 1, hop)])
    angles = 2 * math.pi * np.outer(np.arange(frame), np.arange(frame // 2 + 1)) / frame
    power = (frames @ np.cos(angles)) ** 2 + (frames @ np.sin(angles)) ** 2
    to_mel, to_hz = (lambda f: 2595 * math.log10(1 + f / 700)), (lambda m: 700 * (10 ** (m / 2595) - 1))
    edges = [to_hz(to_mel(1500) * i / (mels + 1)) for i in range(mels + 2)]
    bank = np.zeros((frame // 2 + 1, mels))
    for b in range(frame // 2 + 1):
        f = 1500 * b / (frame // 2)
        for m in range(mels):
            bank[b, m] = max(0.0, min((f - edges[m]) / (edges[m + 1] - edges[m]), (edges[m + 2] - f) / (edges[m + 2] - edges[m + 1])))
    energy = 10 * np.log10((frames**2).mean(axis=1) + 1e-9)
    level, spans, run = energy - np.median(energy), [], []
    for n, v in enumerate([*level, -math.inf]):
        if v > low:
            run.append(n)
            continue
        if run and max(level[i] for i in run) > high:
            spans.append([run[0] * hop / 3000, min(len(payload) / 8000, (run[-1] * hop + frame) / 3000)])
        run = []
    return np.log10(power @ bank + 1e-6), spans


def _terms(text, features):
    """Shares of hashed words, shapes and repeats."""
    out, tokens = Counter(), text.encode().split()
    for word in tokens:
        shape = word
        for pattern, to in ((rb"[a-z\x80-\xff]+", b"a"), (rb"[A-Z]+", b"A"), (rb"[0-9]+", b"9"), (rb"([^aA9])\1+", rb"\1\1")):
            shape = re.sub(pattern, to, shape)
        out[zlib.crc32(b"w" + word.lower()) % features] += 1
        out[zlib.crc32(b"s" + shape) % features] += 1
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
    if repeats:
        out[zlib.crc32(b"repeat") % features] += repeats
    dense = np.zeros(features)
    for term, n in out.items():
        dense[term] = math.sqrt(n / len(tokens))
    return dense


def latent_vectors(labelled, texts, features, dims):
    """TF-IDF of both, projected on the labelled rows' leading singular vectors, by numpy's own decomposition."""
    a, b = (np.array([_terms(t, features) for t in ts]) for ts in (labelled, texts))
    df = (a > 0).sum(axis=0)
    idf = np.where(df > 0, np.log((1 + len(a)) / np.maximum(df, 1)) + 0.2, 0)
    a, b = a * idf, b * idf
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
    basis = np.linalg.svd(a, full_matrices=False)[2][:dims].T
    return a @ basis, b @ basis


def votes(labelled, vectors, goods, neighbours, power):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    out = []
    for cosines in unit(vectors) @ unit(labelled).T:
        nearest = sorted(range(len(goods)), key=lambda i: -cosines[i])[:neighbours]
        weights = [max(cosines[i], 0) ** power for i in nearest]
        out.append(sum(w * goods[i] for w, i in zip(weights, nearest, strict=True)) / sum(weights) if sum(weights) > 1e-12 else sum(goods) / len(goods))
    return np.array(out)
