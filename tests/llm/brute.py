"""Plain-Python statements of the operators' results, for small inputs."""

import collections
import hashlib
import re

WHITE = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    covered = {i + k for i in range(n - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def exact_groups(rows):
    """rows of (doc_id, text) -> {sha: (count, (minus length, null id, id) of the best)}"""
    groups = collections.defaultdict(list)
    for i, t in rows:
        own = sha(re.sub("[\x20\x09-\x0D]", "", t or ""))
        groups[own].append((-len(t or ""), i is None, i or 0))
    return {k: (len(v), min(v)) for k, v in groups.items()}


def line_dedup(rows):
    """distinct rows of (doc_id, text) in order -> {doc_id: (lines, removed, text left)}"""
    places = []
    for i, t in rows:
        lines = [(k, x.strip(WHITE)) for k, x in enumerate((t or "").split("\n"))]
        lines = [x for x in lines if x[1]]
        for j in range(len(lines) - 2):
            places.append((i, j, tuple(x[1] for x in lines[j:j + 3]), [x[0] for x in lines[j:j + 3]]))
    seen, gone = set(), collections.defaultdict(set)
    for i, _, window, covers in sorted(places, key=lambda p: p[:2]):
        if window in seen:
            gone[i].update(covers)
        seen.add(window)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        out[i] = (len(lines), len(gone[i]), "\n".join(x for k, x in enumerate(lines) if k not in gone[i]))
    return out


def suffix_dedup(rows, length=100):
    """rows of (doc_id, text), ids unique -> {doc_id: (bytes, removed, spans, bytes left)}"""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            own = data[p:p + length]
            if own in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(own)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, bytes(x for x, g in zip(data, gone, strict=True) if not g))
    return out


def simhash(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=2):
    """[(doc_id, fingerprint)] -> list of the least doc_id of each row's component"""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(prints))]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)
