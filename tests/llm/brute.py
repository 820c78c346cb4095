"""Plain versions of the operators, for small inputs."""

import hashlib
import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def substring(rows, window=20):
    """``[(doc_id, text)]`` to sorted ``(doc_id, n_words, n_removed, sha)``."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    docs = [SPACE_WORD.findall(text or "") for _, text in order]
    seen, out = set(), []
    for (doc_id, _), words in zip(order, docs):
        gone = set()
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone.update(range(s, s + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), sha(kept)))
    return sorted(out, key=str)


def suffix(rows, length=200):
    """``[(doc_id, text)]`` to sorted ``(doc_id, n_bytes, n_removed, n_spans, sha)``."""
    texts = [(text or "").encode() for _, text in rows]
    seen = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            key = t[s : s + length]
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = b"\x01" * length
        spans = re.findall(b"\x01+", bytes(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), sum(gone), len(spans), sha(kept)))
    return sorted(out, key=str)


def simhash(rows, shingle=3, distance=2):
    """``[(doc_id, text)]`` to sorted ``(doc_id, fingerprint, component_id)``."""
    import xxhash

    prints = []
    for _, text in rows:
        words = SPACE_WORD.findall(lower(text))
        width = min(shingle, len(words))
        votes = [
            xxhash.xxh64_intdigest(" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)
        ] if words else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in votes) > len(votes)))
    least = {}
    for (doc_id, _), fp in zip(rows, prints):
        least[fp] = min(least.get(fp, doc_id), doc_id)
    nodes, root = sorted(least), {fp: fp for fp in least}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    ids = {}
    for fp in nodes:
        ids[find(fp)] = min(ids.get(find(fp), least[fp]), least[fp])
    return sorted((d, f"{fp:016x}", ids[find(fp)]) for (d, _), fp in zip(rows, prints))


def decontamination(rows, benchmark, window=10):
    """Rows and ``[(item_id, text)]`` to sorted ``(doc_id, n_words, n_hit, n_items, sha, contaminated)``."""
    windows = {}
    for item, text in benchmark:
        words = PLAIN_WORD.findall(lower(text))
        width = min(window, len(words))
        for s in range(len(words) - width + 1 if width else 0):
            windows.setdefault(tuple(words[s : s + width]), set()).add("" if item is None else str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in rows:
        words, hit, items = PLAIN_WORD.findall(lower(text)), set(), set()
        for size in sizes:
            for s in range(len(words) - size + 1):
                if (found := windows.get(tuple(words[s : s + size]))) is not None:
                    hit.update(range(s, s + size))
                    items |= found
        out.append((doc_id, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return sorted(out, key=str)


def quality_base(rows):
    """``[(doc_id, text)]`` to sorted ``(doc_id, five counts, base_failed)``."""
    out = []
    for doc_id, text in rows:
        text = text or ""
        words = SPACE_WORD.findall(text)
        lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
        times, hit = {}, set()
        for s in range(len(words) - 2):
            times[tuple(words[s : s + 3])] = times.get(tuple(words[s : s + 3]), 0) + 1
        for s in range(len(words) - 2):
            if times[tuple(words[s : s + 3])] > 1:
                hit.update(range(s, s + 3))
        n = len(words)
        out.append((
            doc_id, n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit), n < 50 or 100 * len(hit) > 50 * n,
        ))
    return sorted(out, key=str)


def warc(rows):
    """``[(page_id, html)]`` to sorted ``(page_id, bytes, digest, type, refers_to)``."""
    import base64

    first = {}
    for page_id, html in rows:
        first[html or ""] = max(first.get(html or "", page_id), page_id)
    out = []
    for page_id, html in rows:
        raw, lead = (html or "").encode(), first[html or ""]
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = lead != page_id
        out.append((page_id, len(raw), sha1, "revisit" if again else "response", lead if again else None))
    return sorted(out)


def license_base(rows):
    """``[(doc_id, text)]`` to sorted ``(doc_id, n_words, n_base, first, last, base_labels)``."""
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    out = []
    for doc_id, text in rows:
        words, at, labels = PLAIN_WORD.findall(lower(text)), [], set()
        for i in range(len(words)):
            for phrase, label in phrases.items():
                if tuple(words[i : i + len(phrase)]) == phrase:
                    at.append(i)
                    labels.add(label)
        out.append((
            doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))
        ))
    return sorted(out, key=str)


def secret_base(rows):
    """``[(doc_id, text)]`` to sorted ``(doc_id, n_assign, n_access, n_hex, base_sha256)``."""
    assign = re.compile(
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    )
    kinds = (("assign", assign, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 18), ("hex", re.compile("[0-9a-f]+"), 16))
    out = []
    for doc_id, text in rows:
        spans, n = [], []
        for rank, (kind, pattern, least) in enumerate(kinds):
            group = 2 if kind == "assign" else 0
            found = [m for m in pattern.finditer(text or "") if len(m[group]) >= least]
            n.append(len(found))
            spans += [(m.start(), rank, m.end(), kind) for m in found]
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
        out.append((doc_id, *n, sha(joined)))
    return sorted(out, key=str)
