"""Plain versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

NON_SPACE = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def repeats(rows, length=400):
    starts = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, x in texts:
        starts.update(x[i:i + length] for i in range(len(x) - length + 1))
    out = []
    for d, x in texts:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if starts[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((d, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                    sha(bytes(c for c, g in zip(x, gone) if not g))))
    return out


def words_and_repeats(text):
    text = text or ""
    words = re.findall(NON_SPACE, text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(NON_SPACE, line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again),
            len(words) < 20 or 100 * len(again) > 30 * len(words))


def shingles(text):
    words = re.findall(NON_SPACE, lower(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids, parent = sorted(sets), {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def contamination(rows, items):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        size = min(10, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[s:s + size])].add(name)
    out = []
    for d, text in rows:
        w, hit, found = words(text), set(), set()
        for s in range(len(w)):
            for size in range(1, 11):
                names = windows.get(tuple(w[s:s + size])) if s + size <= len(w) else None
                if names:
                    found |= names
                    hit |= set(range(s, s + size))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def counts_and_digest(spans, kinds):
    spans = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (*(sum(s[0] == k for s in spans) for k in kinds), sha(line))


def secrets(text):
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return counts_and_digest(spans, ["assign", "access", "hex"])


def personal(text):
    text = text or ""

    def luhn(s):
        v = [int(c) for c in s][::-1]
        return (sum(v[::2]) + sum(sum(divmod(2 * x, 10)) for x in v[1::2])) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return counts_and_digest(spans, ["email", "ip", "card", "phone"])
