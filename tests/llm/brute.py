"""Brute-force versions of the operators' rules, in plain Python."""

import re
from collections import Counter, defaultdict

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(rows, k, num, den):
    """(doc_id, set size, component) and the number of links between different sets."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(ASCII_LOWER))
        grams = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []
        sets.append(frozenset(grams))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, common, links = defaultdict(list), Counter(), set()
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for docs in where.values():
        for x in range(len(docs)):
            for y in range(x):
                common[docs[y], docs[x]] += 1
    for (a, b), c in common.items():
        if c * den >= (len(sets[a]) + len(sets[b]) - c) * num:
            parent[find(a)] = find(b)
            if sets[a] != sets[b]:
                links.add(frozenset((sets[a], sets[b])))
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [(d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)], len(links)


def contamination(docs, items, window=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        if i is not None and w:
            m = min(window, len(w))
            for a in range(len(w) - m + 1):
                windows[tuple(w[a:a + m])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, met = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for a in range(len(w) - m + 1):
                found = windows.get(tuple(w[a:a + m]))
                if found:
                    hit |= set(range(a, a + m))
                    met |= found
        out.append((d, len(w), len(hit), len(met), tuple(sorted(met))))
    return out


def deleted_lines(rows, min_words, key):
    """Every run of lines, by definition: (doc_id, lines, removed, text)."""
    first, gone = {}, {}
    for k in sorted({(d, key(t)) for d, t in rows}, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        text = next(t for d, t in rows if (d, key(t)) == k)
        lines = [(i, x, len(WORD.findall(x))) for i, x in enumerate((text or "").split("\n")) if WORD.search(x)]
        out = set()
        for s in range(len(lines)):
            n, run = 0, ()
            for e in range(s, len(lines)):
                n, run = n + lines[e][2], (*run, lines[e][1])
                if n >= min_words:
                    f = first.setdefault(run, (k, s))
                    if f != (k, s) and (f[0] != k or f[1] + len(run) <= s):
                        out |= {lines[x][0] for x in range(s, e + 1)}
        gone[k] = out
    result = []
    for d, t in rows:
        g, lines = gone[d, key(t)], (t or "").split("\n")
        rest = "\n".join(x for i, x in enumerate(lines) if i not in g)
        result.append((d, len(lines), len(g), (rest if WORD.search(rest) else "") if g else t))
    return result


def base_counts(doc_id, text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[a:a + 5]) for a in range(len(w) - 4))
    cover = {a + j for a in range(len(w) - 4) if seen[tuple(w[a:a + 5])] > 1 for j in range(5)}
    return (doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w))


def base_spans(text, luhn):
    digits = lambda x: re.sub("[ -]", "", x)
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
               if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
                 if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= len(re.findall("[0-9]", m[0])) <= 15]}


def url_parts(url, rules):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(ASCII_LOWER)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))
