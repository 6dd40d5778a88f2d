"""Plain versions of the operators, from their definitions, for small inputs."""

import collections
import hashlib
import math
import re

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def base_secrets(text):
    text = text or ""
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    counts = collections.Counter(k for _, k, _ in spans)
    names = ("assign", "access", "hex")
    listed = [f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans)]
    return [counts[k] for k in range(3)], listed


def window_entropies(text, w):
    def entropy(part):
        n = collections.Counter(part)
        return -sum(c / w * math.log2(c / w) for c in n.values())

    return [entropy(text[i : i + w]) for i in range(len(text) - w + 1)]


def components(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def fingerprint(text, shingle=3):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)]
    if not shingles and words:
        shingles = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, bits=2):
    """{id: (fingerprint, component)} of docs {id: text}."""
    prints = {i: fingerprint(t) for i, t in docs.items()}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= bits]
    root = components(ids, links)
    return {i: (prints[i], root[i]) for i in ids}


def words(text):
    return WORDS.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def contamination(docs, items, window=10):
    """{id: (n_words, n_hit, items)} of docs {id: text} and items [(id, text)]."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows[tuple(w[i : i + window])].add(str(item))
    out = {}
    for ident, text in docs.items():
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out[ident] = (len(w), len(hit), sorted(found))
    return out


def repeats(docs, length=100):
    """{id: (n_bytes, n_removed, n_spans, kept)} of docs {id: text}."""
    seen, out = set(), {}
    for ident in sorted(docs):
        data = (docs[ident] or "").encode()
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            part = data[k : k + length]
            if part in seen:
                mark[k : k + length] = b"\1" * length
            seen.add(part)
        spans = sum(1 for k, m in enumerate(mark) if m and not (k and mark[k - 1]))
        out[ident] = (len(data), sum(mark), spans, bytes(x for x, m in zip(data, mark) if not m))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in sizes if s not in stopped)
        level = (total - sum(most * sizes[s] for s in stopped)) / rest if rest else 0
        now = {s for s in sizes if s in stopped or level * weight[s] > most * sizes[s]}
        if now == stopped:
            return {s: float(most * sizes[s]) if s in stopped else level * weight[s] for s in sizes}
        stopped = now


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """(code, error, label_error) by position, and the digest, of (id, label, vector) with vectors of equal length."""
    kept = [(i, r) for i, r in enumerate(rows) if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    if not kept:
        return {}, ""
    size = len(kept[0][1][2]) // parts
    cut = {i: [[math.floor(4096 * x) for x in r[2][p * size : (p + 1) * size]] for p in range(parts)] for i, r in kept}
    first = sorted(kept, key=lambda k: (k[1][0] is None, k[1][0] or 0, cut[k[0]]))[:entries]
    books = [[list(cut[i][p]) for i, _ in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            met = collections.defaultdict(list)
            for i, _ in kept:
                met[near(cut[i][p], book)[1]].append(cut[i][p])
            for k, members in met.items():
                book[k] = [sum(c) // len(members) for c in zip(*members)]
    out, by_label = {}, collections.Counter()
    for i, r in kept:
        found = [near(cut[i][p], books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
        by_label[r[1]] += out[i][1]
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    return {i: (*v, by_label[rows[i][1]]) for i, v in out.items()}, digest


def place(url):
    """(host, path) of an address."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lowered, re.match(r"[^?#]*", rest[len(host) :])[0]


def best_rule(url, rules):
    host, path = place(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)


def judge_urls(urls, links, rules):
    """(host, path, rule, verdict) of addresses, with links between addresses in the form that is compared."""

    def form(url):
        return (url or "").split("#")[0]

    nodes = {form(u) for u in urls if u} | {form(x) for link in links for x in link}
    root = components(sorted(nodes), [(form(a), form(b)) for a, b in links])
    said = collections.defaultdict(set)
    for n in nodes:
        if rule := best_rule(n, rules):
            said[root[n]].add(rule.verdict)
    out = []
    for u in urls:
        rule = best_rule(u, rules)
        of_class = said[root[form(u)]] if u else set()
        verdict = rule.verdict if rule else "block" if of_class == {"block"} else "allow"
        out.append((*place(u), rule.name if rule else None, verdict))
    return out


def divergence(rows, least=3, top=200):
    """The rows of the audit, of (text, lang, source)."""
    letters = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    upper = {c: c + 32 for c in range(65, 91)}
    docs = [(letters.findall((t or "").translate(upper)), la or "", s or "") for t, la, s in rows]
    out = []
    for lang in {la for _, la, _ in docs}:
        held = collections.Counter(w for ws, la, _ in docs if la == lang for w in set(ws))
        kept = sorted(w for w, n in held.items() if n >= least)
        groups = {s: collections.Counter() for _, la, s in docs if la == lang}
        for ws, la, s in docs:
            if la == lang:
                groups[s].update(w for w in ws if held[w] >= least)

        def values(counts):
            size = sum(counts.values()) + len(kept)
            return [1 + 1_000_000_000 * (counts[w] + 1) // size for w in kept]

        whole = values(sum(groups.values(), collections.Counter()))
        p = {s: values(c) for s, c in groups.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s, counts in groups.items():
            pairs = [(-sum(map(f, p[s], p[o])), o.encode(), "pair") for o in groups if o != s]
            own = [(-f(a, b), w.encode(), "term") for w, a, b in zip(kept, p[s], whole) if counts[w] and a > b]
            for listed in (sorted(pairs), sorted(own)[:top]):
                out += [(lang, s, kind, item.decode(), -v, k) for k, (v, item, kind) in enumerate(listed, 1)]
    return sorted(out)
