"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups(links, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(rows, n, percent):
    """{doc_id: (size, component)} of (doc_id, text) rows, comparing all that share a shingle."""
    sets = {i: shingles(t, n) for i, t in rows}
    holders, shared = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for h in holders.values():
        for k, a in enumerate(h):
            for b in h[:k]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), c in shared.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]
    parts = groups(links, sets)
    return {i: (len(s), parts[i]) for i, s in sets.items()}


def _token_bytes():
    """Both tokenizers' ways from a text to ids and from an id to bytes."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    value = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    table = {i: bytes(value[c] for c in t) for t, i in one.get_vocab(with_added_tokens=False).items()}

    def piece(i):
        name = two.id_to_piece(i)
        return bytes([int(name[1:-1], 16)]) if two.is_byte(i) else name.replace("▁", " ").encode()

    return (lambda t: one.encode(" " + t, add_special_tokens=False).ids, table.get), (two.encode, piece)


def alignments(rows):
    """The alignment's row of each (doc_id, text), from whole texts."""
    import hashlib
    from collections import Counter

    (encode_a, bytes_a), (encode_b, bytes_b) = _token_bytes()
    found, met = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        if not text or b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            found.append((doc, None))
            continue
        owner = [[k for k, i in enumerate(ids) for _ in of(i)] for ids, of in ((a, bytes_a), (b, bytes_b))]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(*owner)))]
        met.update(links)
        ends = [{k + 1 for k in range(len(o)) if k + 1 == len(o) or o[k] != o[k + 1]} for o in owner]
        groups, last = [], 0
        for cut in sorted(ends[0] & ends[1]):
            sides = [",".join(str(ids[k]) for k in sorted(set(o[last:cut]))) for ids, o in zip((a, b), owner)]
            groups.append("|".join(sides))
            last = cut
        found.append((doc, (len(a), len(b), groups, links)))
    best = defaultdict(int)
    for (_, b), n in met.items():
        best[b] = max(best[b], n)
    for doc, x in found:
        if x is None:
            yield doc, 0, 0, 0, 0, 0, 0, ""
        else:
            a, b, groups, links = x
            n_best, total = sum(met[k] == best[k[1]] for k in links), sum(met[k] for k in links)
            yield doc, a, b, len(groups), len(links), n_best, total, hashlib.sha256(";".join(groups).encode()).hexdigest()
