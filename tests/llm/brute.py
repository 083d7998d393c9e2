"""Plain versions of the contracts, for small tables: no hashing tricks, no Spark."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {i + j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(5)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(inside),
        "base_failed": len(w) < 10 or 100 * len(inside) > 20 * len(w),
    }


def repeats(rows, width=35):
    counts = Counter(tuple(w[i : i + width]) for _, t in rows for w in [words(t)] for i in range(len(w) - width + 1))
    out = {}
    for one, text in rows:
        w = words(text)
        gone = {i + j for i in range(len(w) - width + 1) if counts[tuple(w[i : i + width])] > 1 for j in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[one] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, k):
    w = words(lower_ascii(text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def near(rows, k=4, percent=80):
    sets = {one: shingles(text, k) for one, text in rows}
    parent = {one: one for one in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, ids = defaultdict(list), sorted(sets)
    for one in ids:
        for s in sets[one]:
            holders[s].append(one)
    for a in ids:
        shared = Counter(b for s in sets[a] for b in holders[s] if b > a)
        for b, n in shared.items():
            if n * 100 >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {one: (len(sets[one]), root(one), root(one) == one) for one in ids}


def leaks(rows, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = BENCH_WORD.findall(lower_ascii(text or ""))
        for i in range(max(len(w) - width, 0) + 1):
            if w:
                windows[tuple(w[i : i + width])].add(item)
    lengths, out = {len(x) for x in windows}, {}
    for one, text in rows:
        w, hit, found = BENCH_WORD.findall(lower_ascii(text or "")), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        joined = ",".join(sorted(str(x) for x in found))
        out[one] = (len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
    return out


def token_ids(texts, path, end=1):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end], "<u4") for t in texts]


def crc(ids):
    return zlib.crc32(ids.astype("<u4").tobytes())


def check_pieces(pieces, ids_by_doc, width=2048):
    """Assert the packing contract; returns padding as a share of all positions."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids_by_doc)
    for one, ids in ids_by_doc.items():
        at = 0
        for p in sorted(by_doc[one], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == crc(ids[at : at + p["length"]])
            at += p["length"]
        assert at == len(ids)
    padding = total = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= width
        padding += width - at
        total += width
    return padding / max(total, 1)


def simhash(text, k=3):
    import xxhash

    w = words(lower_ascii(text or ""))
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, linked):
    """The smallest id that each node reaches; nodes are (id or None, value), linked tells values apart."""
    left, out = list(range(len(nodes))), {}
    while left:
        group, edge = [], [left.pop()]
        while edge:
            at = edge.pop()
            group.append(at)
            near_by = [o for o in left if linked(nodes[at][1], nodes[o][1])]
            left = [o for o in left if o not in near_by]
            edge += near_by
        ids = [nodes[i][0] for i in group if nodes[i][0] is not None]
        out |= {i: min(ids, default=None) for i in group}
    return out


def phrases(rows, min_count=10, longest=3, drop_percent=50, top=None):
    """rows: (lang, text)."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            if any(
                100 * b >= drop_percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items() if len(q) > len(p)
            ):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def alignment(rows, path_a, path_b):
    """rows: (id, text); per row the alignment contract, by overlaps of byte ranges."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = [x for x in range(256) if x not in seen]
    table = {chr(x): x for x in seen} | {chr(256 + i): x for i, x in enumerate(unseen)}
    assert decoders.ByteLevel().decode(["Ġa"]) == " a"
    docs = []
    for one, text in rows:
        if not text:
            docs.append((one, [], [], [], []))
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                   for p in map(b.id_to_piece, ids_b)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            docs.append((one, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
        joint = sorted(set(ends_a) & set(ends_b))
        links = [(ids_a[ends_a.index(e)], ids_b[ends_b.index(e)]) for e in joint]
        groups, begin = [], 0
        for e in joint:
            groups.append(",".join(str(i) for i, x in zip(ids_a, ends_a, strict=True) if begin < x <= e) + "|"
                          + ",".join(str(i) for i, x in zip(ids_b, ends_b, strict=True) if begin < x <= e))
            begin = e
        docs.append((one, ids_a, ids_b, links, groups))
    count = Counter(pair for d in docs for pair in d[3])
    highest = Counter()
    for (_, y), c in count.items():
        highest[y] = max(highest[y], c)
    return [
        (one, len(ids_a), len(ids_b), len(groups), len(links), sum(count[p] == highest[p[1]] for p in links),
         sum(count[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else "")
        for one, ids_a, ids_b, links, groups in docs
    ]
