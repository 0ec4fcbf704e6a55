"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def line_dedup(docs, min_docs=3, min_points=20):
    """docs: (id, text); returns (lines, dropped, kept text) per row."""
    key = lambda line: line.strip(BLANK).translate(LOWER)
    order = lambda i: (i is not None, i or 0)
    holders = defaultdict(list)
    for i, text in docs:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_points:
                holders[k].append(i)
    keeper = {k: max(ids, key=order) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_counts(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def probability_jaccard(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in pairs:
        a, b = sorted((root(x), root(y)))
        parent[b] = a
    return [root(x) for x in range(n)]


def near_classes(texts, threshold=0.8):
    """The class of each text, as the place of its first member."""
    sets = [shingle_counts(text) for text in texts]
    pairs = [
        (x, y)
        for x in range(len(texts))
        for y in range(x)
        if sets[x] and sets[y] and probability_jaccard(sets[x], sets[y]) >= threshold
    ]
    return roots(len(texts), pairs)


def contamination(docs, items, n=10):
    """docs: texts, items: (id, text); returns (words, hit words, sorted item ids) per text."""
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            grams[tuple(w[i : i + n])].add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = grams.get(tuple(w[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((len(w), len(hit), sorted(found)))
    return out


def repeats(texts, length):
    """(bytes, removed, runs, hash of what is left) per text."""
    data = [(text or "").encode() for text in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        runs = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def mix(docs, share=1.5, epochs=2.0, seed="mix"):
    """docs: (id, source, text); returns (size, source size, target, taken) per row."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, _, text in docs]
    total = Counter()
    for (_, source, _), size in zip(docs, sizes):
        total[source] += size
    names = sorted((s for s in total if s is not None)) + [s for s in total if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    full = set()
    while True:
        free = [s for s in names if s not in full and total[s] > 0]
        if not free:
            break
        level = (share * sum(total.values()) - sum(epochs * total[s] for s in full)) / sum(
            weight[s] for s in free
        )
        new = {s for s in free if epochs * total[s] <= level * weight[s]}
        if not new:
            target.update({s: level * weight[s] for s in free})
            break
        full |= new
    target.update({s: epochs * total[s] for s in full})
    left = {s: int(target[s] + 0.5) - int(target[s] // total[s]) * total[s] if total[s] else 0 for s in names}
    order = sorted(
        range(len(docs)),
        key=lambda i: (
            hashlib.md5(f"{seed}:{'' if docs[i][0] is None else docs[i][0]}".encode()).hexdigest(),
            sizes[i],
        ),
    )
    taken = [0] * len(docs)
    for i in order:
        s = docs[i][1]
        part = max(0, min(sizes[i], left[s]))
        left[s] -= part
        taken[i] = (int(target[s] // total[s]) if total[s] else 0) * sizes[i] + part
    return [(sizes[i], total[docs[i][1]], target[docs[i][1]], taken[i]) for i in range(len(docs))]


def quality(docs, max_docs=10, max_share=0.5, min_left=0.5):
    """docs: (id, text, host); per row: counts, base_failed, lost words, lost lines, kept."""
    words = lambda text: re.findall("[^ \t-\r]+", text or "")
    key = lambda line: tuple(re.sub("[0-9]", "0", w.translate(LOWER)) for w in words(line))
    name = lambda i, text: i if i is not None else ("no id", text)
    held, sizes = defaultdict(set), defaultdict(set)
    for i, text, host in docs:
        sizes[host].add(name(i, text))
        for line in (text or "").split("\n"):
            if key(line):
                held[host, key(line)].add(name(i, text))
    frequent = {
        k for k, ids in held.items()
        if len(ids) > max_docs or (len(ids) >= 3 and len(ids) > max_share * len(sizes[k[0]]))
    }
    out = []
    for _, text, host in docs:
        lines, own = (text or "").split("\n"), words(text)
        worded = [line for line in lines if key(line)]
        windows = Counter(zip(own, own[1:], own[2:]))
        repeated = {
            i + j for i, w in enumerate(zip(own, own[1:], own[2:])) if windows[w] > 1 for j in range(3)
        }
        lost = [i for i, line in enumerate(lines) if (host, key(line)) in frequent]
        n_lost = sum(len(words(lines[i])) for i in lost)
        failed = len(own) < 50 or len(repeated) > 0.5 * len(own)
        counts = (
            len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(worded) - len(set(worded)), len(repeated),
        )
        kept = not failed and len(own) - n_lost >= min_left * len(own)
        out.append((*counts, failed, n_lost, lost, kept))
    return out


def repairs(rows):
    """rows: (role, text, fault) in order; the least (cost, audit, text) of all ways, by trying them all.
    Between two rows two new turns are enough."""
    possible = lambda lines: re.fullmatch("s?(ua)*u?", "".join(line[:1] for line in lines))

    def with_new(ways):
        for cost, audit, lines in ways:
            for names in [()] + [(a,) for a in ("user:", "assistant:")] + [
                (a, b) for a in ("user:", "assistant:") for b in ("user:", "assistant:")
            ]:
                if possible(lines + names):
                    yield cost + 3 * len(names), audit + "I" * len(names), lines + names

    ways = list(with_new([(0, "", ())]))
    for role, text, fault in rows:
        more, then = (3 if fault == 3 else 0), []
        for cost, audit, lines in ways:
            then.append((cost + 4, audit + "D", lines))
            if fault not in (1, 2):
                for letter, name, own in (("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)):
                    if name and possible((*lines, name)):
                        then.append((cost + own + more, audit + letter, (*lines, f"{name}:{text}")))
        ways = list(with_new(then))
    ends = [way for way in ways if re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in way[2]))]
    cost, audit, lines = min(ends)
    return cost, audit, "\n".join(lines)


def trie(paths):
    """paths: conversation -> list of (turn, words); per node (id, depth, parent, members, children, leaves,
    saved words, ids that end)."""
    members = defaultdict(list)
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in members if n}
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), sum(n not in inner for n in below),
            sum((len(members[n]) - 1) * n[-1][1] for n in below if n),
            ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(node)),
        ))
    return out
