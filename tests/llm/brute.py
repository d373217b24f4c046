"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def substring_dedup(docs: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_removed, sha256) of (doc_id, text) rows."""
    first: dict[tuple, int] = {}
    words = [WORD.findall(t or "") for _, t in docs]
    for (d, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - window + 1):
            if d is not None:
                g = tuple(w[i:i + window])
                first[g] = min(first.get(g, d), d)
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def shingle_set(text: str | None, n: int = 3) -> frozenset:
    w = WORD.findall(low(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_classes(docs: list[tuple], percent: int = 90, shingle: int = 3) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [(d, shingle_set(t, shingle)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    by_size = sorted((i for i in range(len(sets)) if sets[i][1]), key=lambda i: len(sets[i][1]))
    for x, i in enumerate(by_size):
        a = sets[i][1]
        for j in by_size[x + 1:]:
            b = sets[j][1]
            if 100 * len(a) < percent * len(b):
                break
            same = len(a & b)
            if 100 * same >= percent * (len(a) + len(b) - same):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets)]


def overlaps(docs: list[tuple], items: list[tuple], allowed, window: int = 13, least: int = 5) -> set[tuple]:
    """(doc_id, item_id) with a window of the item in the document, few words replaced."""
    out = set()
    for d, t in docs:
        w = WORD.findall(low(t or ""))
        for k, q in items:
            v = WORD.findall(low(q or ""))
            m = min(len(v), window)
            if d is None or k is None or m < least:
                continue
            for i in range(len(w) - m + 1):
                if any(sum(x != y for x, y in zip(w[i:i + m], v[j:j + m], strict=True)) <= allowed(m) for j in range(len(v) - m + 1)):
                    out.add((d, k))
                    break
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii_base(text: str | None) -> list[tuple]:
    """(start, kind, end) of the checked base spans."""
    out = []
    for k, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def pii_row(doc_id, text: str | None) -> tuple:
    spans = pii_base(text)
    names = list(PII)
    n = Counter(names[k] for _, k, _ in spans)
    listed = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
    return (doc_id, *(n[k] for k in names), hashlib.sha256(listed.encode()).hexdigest())


def conversations(turns: list[tuple]) -> list[tuple]:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 of (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for c, n, r, t in turns:
        by[c].append(((n is not None, n or 0), (r is not None, r or ""), (t is not None, t or ""), r or "", t or ""))
    out = []
    for c, rows in by.items():
        said = [(r, t) for *_, r, t in sorted(rows)]
        loss = "".join(t for r, t in said if r == "assistant")
        out.append((c, len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


def repeated_words(text: str, k: int = 5) -> int:
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    hit = set()
    for i in range(len(w) - k + 1):
        if seen[tuple(w[i:i + k])] > 1:
            hit.update(range(i, i + k))
    return len(hit)


# Alignment -------------------------------------------------------------------


def alignments(docs: list[tuple], a_path: str, b_path: str) -> list[tuple]:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, sha256 of rows, by
    the libraries, byte ranges and all token pairs."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    a_lib, b_lib = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_lib.encode_special_tokens = True
    letters = sorted(ByteLevel.alphabet())
    plain = [b for b in range(256) if chr(b) in letters]
    letter = {chr(b): b for b in plain}
    letter |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}

    def spans(parts: list[bytes]) -> list[tuple]:
        out, at = [], 0
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    found = []
    for d, text in docs:
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        raw_a = [bytes(letter[c] for c in a_lib.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("\u2581", " ").encode()
                 for i, p in ((i, b_lib.id_to_piece(i)) for i in b)]
        whole = (" " + text).encode() if text else b""
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            a, b, raw_a, raw_b = [], [], [], []
        sa, sb = spans(raw_a), spans(raw_b)
        links = [(x, y) for x, (s, e) in zip(a, sa, strict=True) for y, (u, v) in zip(b, sb, strict=True) if s < v and u < e]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(t) for t, (_, e) in zip(ids, sp, strict=True) if low < e <= cut) for ids, sp in ((a, sa), (b, sb))))
            low = cut
        found.append((d, a, b, groups, links))
    count = Counter(pair for *_, links in found for pair in set(links))
    best: dict[int, int] = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return [(d, len(a), len(b), len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for d, a, b, g, links in found]


# Context-tree weighting ------------------------------------------------------


def is_held_out(doc_id) -> bool:
    import zlib
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def language_scores(docs: list[tuple], depth: int) -> list[tuple]:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by a
    tree of dictionaries, one node at a time."""
    import math

    def data(text) -> bytes:
        return "".join(f"{w} " for w in WORD.findall(low(text or ""))).encode() + b"\n"

    nodes: dict[tuple, list] = defaultdict(lambda: [0, 0])  # (context, bits) -> n0, n1

    def choices(raw: bytes):
        padded = b"\n" * depth + raw
        for i in range(depth, len(padded)):
            bits = f"{padded[i]:08b}"
            for k in range(8):
                yield padded[i - depth:i], bits[:k], int(bits[k])

    for d, t in docs:
        if not is_held_out(d):
            for context, bits, one in choices(data(t)):
                for n in range(depth + 1):
                    nodes[context[depth - n:], bits][one] += 1
    children: dict[tuple, list] = defaultdict(list)
    for context, bits in nodes:
        if context:
            children[context[1:], bits].append((context, bits))

    def log_kt(n0, n1):
        return math.lgamma(n0 + .5) + math.lgamma(n1 + .5) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)

    weighted: dict[tuple, tuple] = {}
    for key in sorted(nodes, key=lambda k: -len(k[0])):
        kt = log_kt(*nodes[key])
        if len(key[0]) == depth:
            weighted[key] = kt, 1.0
        else:
            longer = sum(weighted[c][0] for c in children[key])
            top = max(kt, longer)
            both = top + math.log(math.exp(kt - top) + math.exp(longer - top))
            weighted[key] = both - math.log(2), math.exp(kt - both)

    def predicted(context: bytes, bits: str) -> float:
        p = 0.5
        for n in range(depth, -1, -1):
            key = context[depth - n:], bits
            if key in nodes:
                n0, n1 = nodes[key]
                w = weighted[key][1]
                p = w * (n1 + .5) / (n0 + n1 + 1) + (1 - w) * p
        return p

    tokens = Counter()
    for d, t in docs:
        if not is_held_out(d):
            tokens.update([*WORD.findall(low(t or "")), None])
    n, v = sum(tokens.values()), len(tokens)
    out = []
    for d, t in docs:
        words = [*WORD.findall(low(t or "")), None]
        base = sum(math.log10((tokens[w] + .1) / (n + .1 * (v + 1))) for w in words)
        total = 0.0
        for context, bits, one in choices(data(t)):
            p = predicted(context, bits)
            total += math.log10(p if one else 1 - p)
        out.append((d, is_held_out(d), len(words), sum(tokens[w] > 0 for w in words), n, base, total))
    return out


# Conversation repair ---------------------------------------------------------


def damaged(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) rows after the contract's damage."""
    import zlib
    out = []
    for c, n, r, t in rows:
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if n is None else n}".encode()) % 20
        r, t = " " if r is None else r, " " if t is None else t
        if hit == 1:
            t = ""
        elif hit == 2:
            t = re.sub("[.!?]", "", t)
        elif hit == 4:
            r = "user"
        out += [(c, n, r, t)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def faults(rows: list[tuple]) -> list[str]:
    """First fault of each (role, text)."""
    seen, out = set(), []
    for r, t in rows:
        inked = re.sub(r"[\x20\x09-\x0D]", "", t)
        out.append("blank" if not inked else "duplicate" if (r, t) in seen else "truncated" if inked[-1] not in ".!?" else "")
        seen.add((r, t))
    return out


def cheapest_repair(rows: list[tuple], most_inserted: int) -> tuple:
    """(cost, audit, repaired rows) of (role, text) rows by trying all edits with
    at most ``most_inserted`` insertions in one place."""
    best = None
    bad = faults(rows)

    def go(i: int, cost: int, audit: str, done: list):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for n in range(most_inserted + 1):
            for roles in ([], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]):
                if len(roles) != n:
                    continue
                spent, said, turns = cost + 5 * n, audit + "I" * n, [*done, *((r, "") for r in roles)]
                if i == len(rows):
                    if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)) and (best is None or (spent, said) < best[:2]):
                        best = spent, said, turns
                    continue
                go(i + 1, spent + 2, said + "D", turns)
                if bad[i] in ("", "truncated"):
                    extra = 5 * (bad[i] == "truncated")
                    go(i + 1, spent + extra, said + "K", [*turns, rows[i]])
                    for r in ("user", "assistant"):
                        go(i + 1, spent + 1 + extra, said + "R", [*turns, (r, rows[i][1])])

    go(0, 0, "", [])
    return best


def repaired_conversations(rows: list[tuple], ids: list, solve) -> list[tuple]:
    """The contract's columns of (conv_id, turn, role, text) rows."""
    out = []
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in own if r[1] is not None]
        bad = Counter(faults([r[2:] for r in own]))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, done = solve([r[2:] for r in own])
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad["blank"], bad["duplicate"], bad["truncated"], illegal,
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()))
    return out
