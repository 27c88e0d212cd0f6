"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re


def words(text, lower=False, pattern=r"[^\x20\x09-\x0D]+"):
    if text is None:
        return []
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(pattern, text)


def shingles(text, size):
    w = words(text, lower=True)
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, size, percent):
    """{id: (n_shingles, component, kept)} for (id, text) pairs."""
    sets = {i: shingles(t, size) for i, t in docs}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    links, seen = [], set()
    for ids in index.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * len(sets[a] | sets[b]):
                        links.append((a, b))
    comp = union_find(sets, links)
    return {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def decontamination(docs, items, size=13):
    """{id: (n_words, n_hit, items, contaminated)}."""
    windows = {}
    for item, text in items:
        w = words(text, True, ALNUM)
        if w:
            for i in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[i : i + size]), set()).add(None if item is None else str(item))
    lengths = {len(x) for x in windows}
    out = {}
    for i, text in docs:
        w, hit, found = words(text, True, ALNUM), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k : k + n]))
                if got:
                    found |= got
                    hit.update(range(k, k + n))
        found = sorted(found, key=lambda x: (x is None, x or ""))
        out[i] = (len(w), len(hit), found, bool(hit) and 20 * len(hit) >= len(w))
    return out


def repeats(docs, size):
    """{id: (n_words, n_removed, digest)}; ids must differ."""
    seen, split = {}, {i: words(t) for i, t in docs}
    for i, w in split.items():
        for k in range(len(w) - size + 1):
            seen.setdefault(tuple(w[k : k + size]), []).append((i, k))
    gone = {i: set() for i in split}
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i].update(range(k, k + size))
    return {i: (len(w), len(gone[i]), sha(" ".join(x for k, x in enumerate(w) if k not in gone[i]))) for i, w in split.items()}


def stupid_backoff(docs, min_count=1, alpha=0.4, order=3, corpus=None):
    """{id: (n_words, n_backoff, score)}."""
    import math
    from collections import Counter

    split = {i: words(t) for i, t in docs}
    seen = list(split.values()) if corpus is None else [words(t) for t in corpus]
    count = Counter(tuple(x[p : p + k]) for x in seen for k in range(1, order + 1) for p in range(len(x) - k + 1))
    total, out = sum(len(x) for x in seen), {}
    for i, x in split.items():
        logs, off = [], 0
        for p in range(len(x)):
            longest = k = min(p + 1, order)
            while k > 1 and count[tuple(x[p + 1 - k : p + 1])] < min_count:
                k -= 1
            gram = tuple(x[p + 1 - k : p + 1])
            share = count[gram] / count[gram[:-1]] if k > 1 else max(count[gram], 1) / total
            logs.append(math.log(share) + (longest - k) * math.log(alpha))
            off += k < longest
        out[i] = (len(x), off, sum(logs) / len(logs) if logs else None)
    return out


def line_shingles(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def line_duplicates(docs, percent=80):
    """{id: (lines, kept positions)}."""
    places = {}
    for i, text in docs:
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip():
                places.setdefault(line, []).append((i, pos))
    sets = {x: line_shingles(x) for x in places}
    index = {}
    for x, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(x)
    links, seen = [], {}
    for x, s in sets.items():
        common = {}
        for g in s:
            for y in index[g]:
                if y > x:
                    common[y] = common.get(y, 0) + 1
        links += [(x, y) for y, c in common.items() if 100 * c >= percent * (len(s) + len(sets[y]) - c)]
    root = union_find(sets, links)
    first = {}
    for x, where in places.items():
        first[root[x]] = min(first.get(root[x], min(where)), min(where))
    out = {}
    for x, where in places.items():
        for i, pos in where:
            n, kept = out.setdefault(i, [0, []])
            out[i][0] += 1
            if first[root[x]] == (i, pos):
                kept.append(pos)
    return {i: (n, sorted(k)) for i, (n, k) in out.items()}


def mixture(docs, weights, seed="mix", epochs=3):
    """{id: copies} for (id, source, size) rows and sampling weights by id."""
    import math

    def key(i):
        u = (int(hashlib.md5(f"{seed}{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / weights[i]

    sizes = {}
    for _, source, n in docs:
        sizes[source] = sizes.get(source, 0) + n
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    share = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        total = sum(share[s] for s in open_)
        full = [s for s in open_ if 3 * sizes[s] <= left * share[s] / total]
        if not full:
            target.update({s: left * share[s] / total for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
        left -= sum(3 * sizes[s] for s in full)
        open_ -= set(full)
    copies = {}
    for s in names:
        own = sorted(((key(i), i, n) for i, source, n in docs if source == s))
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, cum = target[s] - whole * sizes[s], 0
        for _, i, n in own:
            cum += n
            copies[i] = whole + (1 if n and rest > 0 and 2 * cum - n < 2 * rest else 0)
    return copies


def crc(text):
    import zlib

    return zlib.crc32(text.encode()) & 0xFFFFFFFF


def damage(rows):
    """(conv, turn, role, text) rows as the conversation test damages them."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest_edits(rows):
    """(cost, audit, repaired lines) of (role, text, fault) rows, by keeping
    the least (cost, audit) of every state before the next row."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    now = {"": (0, "", [])}

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for s, (c, x, lines) in list(out.items()):
                for i, name in names.items():
                    if (s, i) in go:
                        one = (c + 5, x + "I", [*lines, name + ":"])
                        t = go[s, i]
                        if t not in out or one[:2] < out[t][:2]:
                            out[t] = one
        return out

    for role, text, fault in rows:
        after = {}
        stay = 5 if fault == "truncated" else 0

        # insertions are tried from each state by itself: ties are between edit texts that end with a row
        for s0, v in now.items():
            for s, (c, x, lines) in inserted({s0: v}).items():
                moves = [(s, 2, "D", None)]
                if fault not in ("blank", "duplicate"):
                    if (s, role[:1]) in go:
                        moves.append((go[s, role[:1]], stay, "K", f"{role}:{text}"))
                    moves += [(go[s, i], 1 + stay, "R", f"{n}:{text}") for i, n in names.items() if (s, i) in go]
                for t, price, edit, line in moves:
                    one = (c + price, x + edit, lines if line is None else [*lines, line])
                    if t not in after or one[:2] < after[t][:2]:
                        after[t] = one
        now = after
    ends = [inserted({s: v}).get(e) for s, v in now.items() for e in ("", "a")]
    return min((e for e in ends if e), key=lambda e: e[:2])


def conversations(rows):
    """{conv: digest columns} of (conv, turn, role, text) rows."""
    out = {}
    by = {r[0]: [] for r in rows}
    for r in damage(rows):
        by[r[0]].append(r[1:])
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, told, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((role, text, fault))
            if fault:
                counts[fault] += 1
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        cost, audit, lines = cheapest_edits(told)
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, sha("\n".join(lines)))
    return out


def phrase_table(docs, max_words=5):
    """({lang: words}, {(lang, words): count}) for (text, lang) pairs."""
    from collections import Counter

    totals, counts = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, max_words + 1):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return totals, counts


def collocations(docs, min_count=100, max_words=5, percent=100, top=2000):
    totals, counts = phrase_table(docs, max_words)
    found = {p: a for p, a in counts.items() if a >= min_count and len(p[1]) > 1}
    inside = {}
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                p = (lang, w[i : i + m])
                inside[p] = max(inside.get(p, 0), a)
    rows = {}
    for (lang, w), a in found.items():
        if 100 * inside.get((lang, w), 0) >= percent * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    out = []
    for lang, own in rows.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)
