"""Plain Python versions of the text operators, for small inputs."""

import hashlib
import re
import struct
from collections import Counter, defaultdict

import xxhash

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SECRETS = (
    ("assign", ASSIGN, lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
)


def spans(kinds, text):
    return [(k, m.start(), m.end()) for k, p, good in kinds for m in p.finditer(text or "") if good(m)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def listed(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def secrets(text):
    order = {k: i for i, (k, _, _) in enumerate(SECRETS)}
    return sorted(spans(SECRETS, text), key=lambda s: (s[1], order[s[0]]))


def host_path_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
                          ("block", "net/es/"), ("block", "net/fr/")):
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or ("", ""), (rule, verdict), key=lambda b: len(b[0]))
    return host, path, *(best or (None, None))


def grams(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def near(docs, k, percent):
    """{doc_id: (size of its set, smallest doc_id reached)} for distinct ids."""
    sets = {d: grams(t, k) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for o, shared in Counter(o for g in s for o in holders[g] if o > d).items():
            if 100 * shared >= percent * (len(s) + len(sets[o]) - shared):
                a, b = find(d), find(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def spark_hash(*values):
    """Spark's xxhash64 of texts and longs."""
    seed = 42
    for v in values:
        if v is not None:
            data = v.encode() if isinstance(v, str) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def order_minhash(text, k=3, parts=64, size=2):
    words = [spark_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]{1,16}", text)]
    if not words:
        return [0] * parts
    seen, items = Counter(), []
    for i in range(max(1, len(words) - k + 1)):
        key = spark_hash(*words[i:i + k]) >> 30
        items.append(((spark_hash_int(key, seen[key]) >> 30), i))
        seen[key] += 1
    items.sort()
    out = []
    for p in range(parts):
        first = next((i for i, (h, _) in enumerate(items) if (h >> 28) + parts // 2 >= p), 0)
        taken = [items[(first + r) % len(items)] for r in range(min(size, len(items)))]
        out.append(spark_hash(*[h for h, _ in sorted(taken, key=lambda t: t[1])]) >> 32)
    return out


def spark_hash_int(key, number):
    """xxhash64 of a long and an int."""
    seed = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    seed = xxhash.xxh64_intdigest(struct.pack("<i", number), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def without_repeated_runs(docs):
    """{doc_id: text} for distinct ids."""
    places = defaultdict(list)
    for d, t in docs:
        lines = (t or "").split("\n")
        for i, two in enumerate(zip(lines, lines[1:])):
            if re.search(r"[^\x20\x09-\x0D]", "".join(two)):
                places[two].append((d, i))
    gone = defaultdict(set)
    for found in places.values():
        first, *others = sorted(found)
        for d, i in others:
            gone[d].update({i, i + 1} - ({i} if (d, i - 1) == first else set()))
    return {d: t if not gone[d] else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in docs}
