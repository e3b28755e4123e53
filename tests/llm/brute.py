"""Plain, slow versions of the operators, for comparison."""

import hashlib
import re
import zlib

import xxhash

WORD5 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
    fit = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def exact(rows):
    groups = {}
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def licenses(rows, phrases, templates, threshold, block_end):
    out = []
    for i, text in rows:
        body = (text or "").translate(LOWER)
        words = WORD5.findall(body)
        places, labels = [], set()
        for phrase, label in phrases.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        more, score = set(), 0.0
        for block in re.split(block_end, body):
            held = set(WORD5.findall(block))
            for label, t in templates:
                wanted = set(re.findall(r"[0-9a-z]+", t.lower()))
                if len(held & wanted) >= threshold * len(wanted) - 1e-9:
                    more.add(label)
                    score = max(score, len(held & wanted) / len(wanted))
        out.append((i, len(words), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | more)), 1.0 if places else score))
    return out


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows):
    prints = [(i, simhash(t)) for i, t in rows]
    return components(prints)


def components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= 3:
                root[find(a)] = find(b)
    groups = {}
    for a, (i, _) in enumerate(prints):
        groups.setdefault(find(a), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return [(i, f"{fp:016x}", least[find(a)]) for a, (i, fp) in enumerate(prints)]


def leaks(rows, items, shingle=5, least=0.8):
    """All windows of every item's size, every pair compared."""
    from collections import Counter

    def words(t):
        return re.findall(r"[^\W_]+", (t or "").lower())

    out = []
    for i, text in rows:
        w = words(text)
        for item, body in items:
            b = words(body)
            if not b or not w:
                continue
            k = min(shingle, len(b))
            size = min(len(b), len(w))
            if size < k:
                continue
            target = Counter(zip(*(b[j:] for j in range(k))))
            best = (0, 0)
            for s in range(len(w) - size + 1):
                window = Counter(zip(*(w[s + j:s + size] for j in range(k))))
                value = sum((window & target).values()) / sum((window | target).values())
                if value > best[0]:
                    best = (value, s)
            if best[0] >= least:
                out.append((i, item, best[0], best[1], size))
    return out


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def spelling(rows):
    """word -> (form, root, n, n_near, form_n) by comparing every pair of words."""
    counts = {}
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            if i is not None:
                h = zlib.crc32(f"{i}:{w}".encode())
                if h % 199 == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1:]
            if len(w) >= 6:
                counts[w] = counts.get(w, 0) + 1
    words = {w: n for w, n in counts.items() if n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    form = {}
    out = {}
    for w, n in words.items():
        close = [v for v in words if v != w and near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = [n, len(close), words[form[w]] if form[w] else None]
    result = {}
    for w, (n, n_near, form_n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        result[w] = (form[w], root, n, n_near, form_n)
    return result


def mixing(rows, targets, block_of=lambda doc_id: 0):
    """doc_id -> (size, source_size, target, taken) with carried rounding, for the rows (doc_id, text, source)."""
    import math

    sizes = {}
    sized = []
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] = sizes.get(s, 0) + n
        sized.append((i, s, n))
    goal = targets(sizes)
    rate = {s: goal[s] / sizes[s] if sizes[s] else 0.0 for s in sizes}
    out = []
    groups = {}
    for i, s, n in sized:
        groups.setdefault((s, block_of(i)), []).append((i, n))
    for (s, _), members in groups.items():
        def order(m):
            if m[0] is None:
                return (42, True, 0, m[1])
            h = xxhash.xxh64_intdigest(m[0].to_bytes(8, "little", signed=True), 42)
            return (h - (1 << 64) if h >= 1 << 63 else h, False, m[0], m[1])

        members.sort(key=order)
        base = min(math.floor(rate[s]), 3)
        owed = 0.0
        for i, n in members:
            owed += (rate[s] - base) * n
            extra = 1 if base < 3 and n > 0 and owed >= n / 2 else 0
            owed -= extra * n
            out.append((i, n, sizes[s], goal[s], (base + extra) * n))
    return out


def lexical_search(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    import math

    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    rows = [(i, term.findall((t or "").translate(LOWER))) for i, t in docs]
    rows = [(i, ts) for i, ts in rows if ts]
    big_n, big_l = len(rows), sum(len(ts) for _, ts in rows)
    df = {}
    for _, ts in rows:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    w = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * d + 1))) for t, d in df.items()}
    vectors = []
    for i, ts in rows:
        m = 25 + (75 * len(ts) * big_n) // big_l
        tf = {}
        for t in ts:
            tf[t] = tf.get(t, 0) + 1
        vectors.append((i, {t: (10 ** 9 * f) // (1000 * f + 8 * m) for t, f in tf.items()}))
    out = []
    for item, text in items:
        q = term.findall((text or "").translate(LOWER))
        scored = [(sum(w.get(t, 0) * v.get(t, 0) for t in q), i) for i, v in vectors]
        scored = [(s, i) for s, i in scored if s > 0]
        scored.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0))
        out.extend((item, r + 1, i, s) for r, (s, i) in enumerate(scored[:top]))
    return out
