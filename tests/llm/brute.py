"""Plain readings of the operators' contracts, for small tables."""

import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    t = text or ""
    return WORD.findall(t.translate(LOWER) if lower else t)


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def classes(docs):
    """{doc_id: (shingles, smallest linked doc_id)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def quality_counts(text):
    w = words(text, lower=False)
    t = text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {k for i, x in enumerate(windows) if often[x] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def warc_rows(pages):
    import hashlib

    held = defaultdict(lambda: -1)
    facts = {}
    for i, h in pages:
        b = (h or "").encode()
        facts[i] = (len(b), hashlib.sha1(b).hexdigest())
        if len(b) >= 1000:
            held[facts[i]] = max(held[facts[i]], i)
    return {i: (*f, "response", None) if f[0] < 1000 or held[f] == i else (*f, "revisit", held[f]) for i, f in facts.items()}


def chosen_blocks(b, h):
    """Main text by tag-path ratios, read plainly: loops over blocks and the
    elements above them; ``h`` gives the thresholds."""
    n = len(b.text)

    def above(k):
        out = [k]
        while b.parent[out[-1]] >= 0:
            out.append(b.parent[out[-1]])
        return out

    size = [len(t) for t in b.text]
    points = [sum(c in ".,;:!?…。，；：！？、" for c in t) for t in b.text]
    inside = defaultdict(int)
    for i in range(n):
        for k in above(b.node[i]):
            inside[k] += size[i]

    def marked(k):
        wraps = b.tag[k] in ("div", "section", "form", "table", "tr", "td", "tbody", "center") and inside[k] >= h.WRAPPER * inside[0]
        return b.marked[k] and not wraps

    soft = [any(marked(k) for k in above(b.node[i])) for i in range(n)]
    if all(soft):
        return [False] * n
    path = [b.path[k] for k in b.node]
    mean = lambda xs: sum(xs) / len(xs)
    text = [math.log1p(mean([size[j] for j in range(n) if path[j] == path[i]])) for i in range(n)]
    point = [math.log1p(mean([points[j] for j in range(n) if path[j] == path[i]])) for i in range(n)]
    smooth = lambda v, i: (v[max(i - 1, 0)] + 2 * v[i] + v[min(i + 1, n - 1)]) / 4
    share = [b.linked[i] / size[i] for i in range(n)]
    each = [math.exp((smooth(text, i) + smooth(point, i)) / 2) * (h.LABELLED if soft[i] else 1) * (1 - 0.9 * share[i]) for i in range(n)]
    score = [mean([each[j] for j in range(n) if path[j] == path[i] and soft[j] == soft[i]]) for i in range(n)]
    free = [i for i in range(n) if not soft[i]]
    least = h.THRESHOLD * sum(score[i] * size[i] for i in free) / sum(size[i] for i in free)
    listed = [share[i] >= h.LINKED and b.links[i] >= 2 for i in range(n)]
    content = [score[i] >= least * (1 - 1e-12) and not listed[i] for i in range(n)]
    out = list(content)
    for i in free:
        if content[i] or listed[i] or share[i] >= h.MOSTLY:
            continue
        held = lambda k, some: sum(size[j] for j in some if k in above(b.node[j]))
        good = [j for j in range(n) if content[j]]
        home = next((k for k in above(b.node[i]) if held(k, good)), 0)
        along = b.tag[home] not in ("", "html", "body") and held(home, good) >= h.MOSTLY * held(home, free)
        head = b.tag[b.node[i]] in ("h1", "h2", "h3", "h4", "h5", "h6") and i + 1 < n and content[i + 1]
        out[i] = along or head
    return out


def template(text, d, initial=False):
    """(words, word -> token, tokens, values) of an ASCII text, read plainly."""
    kinds, words, values, place, inner = [], [], [], [], False
    for line in (text or "").split("\n"):
        opens = True
        for raw in re.findall(r"[^\x20\x09-\x0D]+", line):
            core = re.search(r"[A-Za-z0-9].*[A-Za-z0-9]|[A-Za-z0-9]", raw)
            after = raw[core.end() :] if core else raw
            if core:
                w = core[0].lower()
                if any(c.isdigit() for c in w) or w in d._NUMBER_WORDS:
                    kind = "#number"
                elif kinds and kinds[-1] == "#number" and w in d._UNITS:
                    kind = "#unit"
                elif core[0][0].isupper() and (initial or not opens):
                    kind = "#name"
                else:
                    kind = w
                before, inner = inner, kind == "#name" and not opens
                if before and inner:
                    values[-1] = w
                else:
                    kinds.append(kind)
                    values.append(w)
                words.append(w)
                place.append(len(kinds) - 1)
                opens = any(c in ".!?:;" for c in after)
    return words, place, kinds, values


def leaks(docs, items, d):
    """(doc, item, covered, renamed) of all pairs, by comparing every window."""
    out = []
    number = {}
    code = lambda x: number.setdefault(x, len(number) + 10)
    marks = {"#number": 1, "#name": 2, "#unit": 3}
    for item, text in items:
        for doc, body in docs:
            best, same = [], []
            for initial in (False, True):
                words, place, kinds, values = template(text, d, initial)
                size = min(d.WINDOW, len(kinds))
                least = d.LITERALS if size == d.WINDOW else d.SHORT_LITERALS
                w2, _, k2, v2 = template(body, d, initial)
                hits = [
                    (i, j, [code(v) for v in v2[j : j + size]]) for i in range(len(kinds) - size + 1) for j in range(len(k2) - size + 1)
                    if size and kinds[i : i + size] == k2[j : j + size] and sum(k not in marks for k in kinds[i : i + size]) >= least
                ]
                got = d.judge(hits, [marks.get(k, code(k)) for k in kinds], [code(v) for v in values])
                if got:
                    best.append((not got[3], got[2], got[0]))
                if not initial:
                    run = min(d.EXACT, len(words))
                    same = {i for i in range(len(words) - run + 1) for j in range(len(w2) - run + 1) if run and words[i : i + run] == w2[j : j + run]}
                    own = len({place[k] for i in same for k in range(i, i + run)})
            if best:
                out.append((doc, item, max(best)[2], not max(best)[0]))
            elif same:
                out.append((doc, item, own, False))
    return out


def quality_features(text, markers):
    """The statistics of a text in the order of the model's features."""
    import regex

    t = text or ""
    w = words(t, lower=False)
    n, chars, symbols, dup, repeat = quality_counts(t)
    if not n:
        return [0.0] * 14
    sizes = {len(b) for b in markers.beginnings}
    found = Counter(x for x in regex.findall(r"\p{L}[\p{L}\p{M}]*", t.lower()) if x in markers.words or any(x[:k] in markers.beginnings for k in sizes))
    lines = len(t.split("\n"))
    stutter = sum(a == b for a, b in zip(w, w[1:], strict=False))
    share = lambda p: len(regex.findall(p, t)) / chars
    return [n, chars / n, symbols / chars, dup / lines, min(1, repeat / n), stutter / n, share(r"\p{L}"), share(r"\p{N}"), len(re.findall("[.,;:!?]", t)) / n, n / lines, len(set(w)) / n, max(Counter(w).values()) / n, len(found), sum(found.values()) / n]


def tree_chance(trees, x):
    """The chance that boosted trees give, walked node by node."""
    total = trees.bias
    for node in trees.roots:
        while trees.left[node] != node:
            node = trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    return 1 / (1 + math.exp(-total))


def language(text, samples):
    """The language of least normalised phrases, by searching the samples."""
    import regex

    form = lambda t: regex.sub(r"[^\p{L}]+", " ", t)
    lower = lambda t: "".join(c.lower() if len(c.lower()) == 1 and regex.match(r"\p{L}", c) else c for c in t)
    t = lower(form(text or "")).lstrip(" ")
    if not regex.search(r"\p{L}", t):
        return "und"
    rates = []
    for lang in sorted(samples):
        s = lower(form(samples[lang])).lstrip(" ")
        n = i = 0
        while i < len(t):
            k = 1
            while i + k <= len(t) and t[i : i + k] in s:
                k += 1
            i += max(1, k - 1)
            n += 1
        rates.append((n * math.log2(max(2, len(s))), lang))
    return min(rates)[1]
