"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def shingles(text, words):
    found = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + words]) for k in range(max(len(found) - words + 1, 1)))


def components(texts: dict, words: int, least: int) -> dict:
    """doc_id -> smallest doc_id of its group, over all pairs that share a shingle."""
    sets = {i: shingles(t, words) for i, t in texts.items()}
    by_shingle, parent = defaultdict(list), {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in by_shingle[s])
        for j, n in shared.items():
            if 100 * n >= least * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            by_shingle[s].append(i)
    return {i: root(i) for i in texts}


def cut(texts: dict, width: int = 50) -> dict:
    """doc_id -> (bytes, covered flags): bytes under strings that also start in a document with a smaller id."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        covered = bytearray(len(data))
        windows = [data[k : k + width] for k in range(len(data) - width + 1)]
        for k, w in enumerate(windows):
            if w in seen:
                covered[k : k + width] = b"\1" * width
        seen.update(windows)
        out[i] = data, bytes(covered)
    return out


def edit_distance_within(pattern: str, text: str) -> int:
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def url_verdicts(pages: dict, rules, max_branches, deviation, prior, reject_from):
    """page_id -> (host, path, rule, verdict, template), with the tree walked node by node."""
    rows = {}
    for page_id, url in pages.items():
        found = re.match("(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[2].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), found[3]) if found else ("", "")
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        rule = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        rows[page_id] = host, path, rule, tuple(re.sub("[0-9]+", "#", re.sub("^/", "", path)).split("/"))
    template = {(h, shape): "" for h, _, _, shape in rows.values()}
    blocked = Counter((h, shape) for h, _, rule, shape in rows.values() if rule and rule[0] == "block")
    labelled = Counter((h, shape) for h, _, rule, shape in rows.values() if rule)
    for level in range(max(len(shape) for _, shape in template)):
        nodes = defaultdict(lambda: defaultdict(list))
        for (h, shape), t in template.items():
            if level < len(shape):
                nodes[h, t][shape[level]].append((h, shape))
        for branches in nodes.values():
            count = lambda what, keys: sum(what[k] for k in keys)
            every = [k for keys in branches.values() for k in keys]
            all_b, all_l = count(blocked, every), count(labelled, every)
            for name, keys in branches.items():
                b, n = count(blocked, keys), count(labelled, keys)
                rest = all_l - n
                apart = False
                if n and rest:
                    share = all_b / all_l
                    error = (share * (1 - share) * (1 / n + 1 / rest)) ** 0.5
                    apart = abs(b / n - (all_b - b) / rest) > deviation * error
                alone = len(branches) == 1 or (len(branches) <= max_branches and apart)
                for k in keys:
                    template[k] += "/" + (name if alone else "*")
    totals = lambda key: (sum(blocked[k] for k in template if key(k)), sum(labelled[k] for k in template if key(k)))
    b, n = totals(lambda k: True)
    overall, purity = b / n if n else 0.0, {}
    for (h, shape), t in template.items():
        if (h, t) not in purity:
            hb, hl = totals(lambda k: k[0] == h)
            tb, tl = totals(lambda k: k[0] == h and template[k] == t)
            purity[h, t] = (tb + prior * (hb + prior * overall) / (hl + prior)) / (tl + prior)
    return {page_id: (h, path, rule and rule[1] + rule[2],
                      rule[0] if rule else "block" if purity[h, template[h, shape]] >= reject_from else "allow", template[h, shape])
            for page_id, (h, path, rule, shape) in rows.items()}


def license_runs(text: str, templates: dict, least: int) -> list:
    """(start, end, template, n_bigrams, n_shared) of the runs of words, over all of them, before lines are looked at."""
    words = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    grams, found = list(zip(words, words[1:])), []
    for name, template in templates.items():
        own = re.sub("[^a-z0-9]+", " ", template.lower()).split()
        wanted = set(zip(own, own[1:]))
        for start in range(len(grams)):
            for end in range(start, min(len(grams), start + (200 - least) * (len(own) - 1) // least)):
                run = set(grams[start : end + 1])
                shared = len(run & wanted)
                if 200 * shared >= least * (len(run) + len(wanted)):
                    found.append((len(run) + len(wanted) - 3 * shared, len(run), name, start, end, shared))
    kept = []
    for cost, n, name, start, end, shared in sorted(found):
        if not any(start <= e and s <= end for s, e, *_ in kept):
            kept.append((start, end, name, n, shared))
    return sorted(kept)
