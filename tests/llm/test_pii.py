import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import regex

from cloudweft.llm import pii, queries
from tests.llm.corpus import corpus

REGEX = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(digits[::-1])) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in match.split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def plain(text):
    spans = sorted((m.start(), r, m.end(), k) for r, (k, x) in enumerate(REGEX) for m in re.finditer(x, text or "") if valid(k, m.group()))
    return [(k, a, b) for a, _, b, k in spans]


HARD = [
    "mail a@b.co, c.d+e@f-g.h.i; x@y x@.y @z.q", "a@b.c%d@e.f.g_h@i.j", "😀 é a@b.co 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8.9", "007.1.2.3 0300.1.1.1 1.2.3.0000255", "4539 1488 0343 6467 and 4539148803436467 1 2 3",
    "4539-1488-0343-6467 4539148803436468 12345678901234567890", "+1 (217) 555-0100 +44 20 7946 0958. +12 +1+2+3 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+1 (555) 555-5555 x@y.zz 8.8.8.8" * 30, "1.1.1.1" * 5, "9" * 30_000, "a" * 60_000 + "@", ("7 " * 40_000).strip(), "\n\t@ .\r",
]


def test_base_spans_match_brute_force(spark, folder):
    rows = corpus(1, 20) + [(2000 + k, t) for k, t in enumerate(HARD)]
    found = queries.op2_personal_data(spark, folder(rows)).collect()
    got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found)
    want = Counter()
    for i, t in rows:
        spans = plain(t)
        counts = Counter(k for k, _, _ in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[(i, *(counts[k] for k in pii.KINDS), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == want
    for r in found:
        base = {x for x in (r.spans or "").split(",") if x}
        if r.doc_id in dict(rows) and r.doc_id != 908:
            assert {f"{k}:{a}:{b}" for k, a, b in plain(dict(rows)[r.doc_id])} <= base


def test_context_finds_what_the_rules_do_not(spark, table):
    rows = [(k, f"Some words here. Callback: +1 (217) 555-01{k:02d} until noon.") for k in range(30)]
    rows += [(100 + k, f"More words. Callback: 555-77{k:02d}-9 at night, order 2024-{k:02d} came.") for k in range(5)]
    rows += [(200 + k, "Plain prose with order 2023-11 and no more.") for k in range(20)]
    found = {r.doc_id: r for r in pii.extract(table(rows)).collect()}
    for k in range(5):
        more = found[100 + k]["more"]
        assert [(m.kind, rows[30 + k][1][m.start : m.end]) for m in more] == [("phone", f"555-77{k:02d}-9")]
    assert not any(found[200 + k]["more"] for k in range(20)) and not any(found[k]["more"] for k in range(30))


def checked(digits):
    return digits + next(c for c in "0123456789" if luhn(digits + c))


def spread(digits):
    return " ".join(digits[k : k + 4] for k in range(0, 16, 4))


def scattered(rng, n=60):
    """Documents with seeds in known contexts, identifiers that the rules miss in the same, and numbers that are none."""
    rows, want = [], {}
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(38)) + "a1"

    def add(before, what, after, kind=None):
        text = f"{prose(rng.randint(2, 6))} {before}"
        if kind:
            want[len(rows)] = {(kind, len(text), len(text) + len(what))}
        rows.append((len(rows), f"{text}{what}{after} {prose(3)}"))

    for _ in range(n):
        add("phone: ", f"+1 (217) 555-{number(4)}", " today")
        add("tel:", f"+44 20 7946 {number(4)}", ".")
        add("paid with card ", spread(checked("4539" + number(11))), ",")
        add("mail to ", f"{word()}{number(1)}@{word()}.com", " now")
        add('token = "', secret(), '"', "secret")
        add("in the year ", str(rng.randint(1900, 2025)), " or so")
        add("about ", number(5), " people")
    for _ in range(5):
        add("phone: ", f"(217) 555-{number(4)}", " today", "phone")
        add("tel:", f"020 7946 {number(4)}", ".", "phone")
        card = "4539" + number(12)
        add("paid with card ", spread(card), ",", None if luhn(card) else "card")
        add("mail to ", f"{word()} [at] {word()}.com", " now", "email")
        add('token = "', f"x{number(9)}y", '"', "secret")
        add("see commit ", secret(), " for it")
    return rows, want


def test_unseen_identifiers_of_several_tokens(spark, table):
    rows, want = scattered(random.Random(5))
    found = {r.doc_id: {(m.kind, m.start, m.end) for m in r["more"]} for r in pii.extract(table(rows)).collect()}
    got = {k: v for k, v in found.items() if v}
    hits = sum(len(got.get(k, set()) & v) for k, v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert hits >= 0.9 * sum(map(len, got.values()))


def contexts(text, found):
    """For each match: up to three tokens before it, the last first, and the word after it; within what lies between matches."""
    out, last = [], 0
    for k, m in enumerate(found):
        pieces = regex.sub("[\t\n\x0b\f\r]", " ", text[last : m.start()]).rstrip(" ").split(" ")[-pii.PIECES :]
        left = [regex.sub("[0-9]+", "0", x.lower()) for x in pieces if x][::-1][:3]
        rest = text[m.end() : found[k + 1].start() if k + 1 < len(found) else len(text)]
        right = regex.match(r"[^\p{L}\p{N}]{0,8}+([\p{L}\p{N}]++)", rest)
        out.append((left, right.group(1).lower() if right else ""))
        last = m.end()
    return out


def occurrences(text):
    """(kind, start, end, instance, patterns) of valid base matches and of candidates apart from them."""
    every = []
    for kind, expression in [*REGEX, ("candidate", pii.REGEX["candidate"])]:
        found = list(regex.finditer(expression, text))
        for m, (left, right) in zip(found, contexts(text, found)):
            own, end = m.group(), m.end()
            if kind == "candidate":
                own = regex.sub(r"[.,;:!?)\]}'\"*#$%&]+$", "", own)
                end = m.start() + len(own)
                if len(own) < 5 or (sum(c in "0123456789" for c in own) < 4 and not regex.search(r"@|[\[({] ?(?i:at) ?[\])}]", own)):
                    continue
            elif not valid(kind, own):
                continue
            own = own.lower()
            plain = regex.sub(r"\p{L}+", "a", regex.sub("[0-9]", "9", own))
            form = f"hex {len(own)}" if re.fullmatch("[0-9a-f]{16,}", own) and re.search("[a-f]", own) else plain
            patterns = [(f"left {k}", *left[:k]) if len(left) >= k else None for k in (1, 2, 3)] + [("right", right) if right else None, ("shape", form)]
            every.append((kind, m.start(), end, own, patterns))
    base = [(a, b) for kind, a, b, *_ in every if kind != "candidate"]
    return [x for x in every if x[0] != "candidate" or all(b <= x[1] or a >= x[2] for a, b in base)]


def bootstrapped(texts):
    """The further spans (document, kind, start, end), by the definition in the module, with dictionaries."""
    kinds = pii.SCORED
    every = [(k, *x) for k, t in enumerate(texts) for x in occurrences(t or "")]
    edges = Counter((p, f, own, kind) for _, kind, _, _, own, patterns in every for f, p in enumerate(patterns) if p)
    total = Counter((own, kind) for _, kind, _, _, own, _ in every)
    members = Counter(p for p, *_ in edges)
    edges = {e: n for e, n in edges.items() if members[e[0]] >= pii.SUPPORT}
    secret = lambda own: len(own) in (32, 40, 64) and bool(re.fullmatch("[0-9a-f]*", own)) and bool(re.search("[0-9]", own)) and bool(re.search("[a-f]", own))
    seed = lambda own, kind: tuple(float(kind == k or (k == "secret" and kind == "candidate" and secret(own))) for k in kinds)
    shapes = defaultdict(lambda: [0] * len(kinds))
    for p, f, own, kind in edges:
        if f == 4:
            shapes[p] = [a + b for a, b in zip(shapes[p], seed(own, kind))]
    score: dict = {}
    for _ in range(pii.ROUNDS):
        sums = defaultdict(lambda: [0.0, 0, [0.0] * len(kinds)])
        for (p, _, own, kind), n in edges.items():
            s = [max(a, b) for a, b in zip(seed(own, kind), score.get(own, (0.0,) * len(kinds)) if kind == "candidate" else (0.0,) * len(kinds))]
            x = sums[p]
            x[0] += n
            x[1] += sum(s) >= pii.INSTANCE_SCORE
            x[2] = [a + n * b for a, b in zip(x[2], s)]
        pattern = {p: [v / (n + 1) for v in s] for p, (n, likely, s) in sums.items() if likely >= pii.SUPPORT and sum(s) / (n + 1) >= pii.PATTERN_SCORE / 2}
        means, form = defaultdict(lambda: [[0.0] * len(kinds) for _ in range(5)]), {}
        for (p, f, own, kind), n in edges.items():
            if kind != "candidate":
                continue
            if f == 4 and sum(shapes[p]) >= pii.SUPPORT:
                form[own] = [v / sum(shapes[p]) for v in shapes[p]]
            if p in pattern:
                means[own][f] = [a + n / total[own, kind] * b for a, b in zip(means[own][f], pattern[p])]
        score = {}
        noisy = lambda m: 1 - (1 - max(m[:3])) * (1 - m[3]) * (1 - m[4])
        for own, m in means.items():
            if own in form:
                whole = noisy([sum(x) for x in m])
                score[own] = [whole * q for q in form[own]]
            else:
                alone = [noisy([x[i] for x in m]) for i in range(len(kinds))]
                best = alone.index(max(alone))
                score[own] = [x if i == best else 0.0 for i, x in enumerate(alone)]
    sure = {p for p, s in pattern.items() if sum(s) >= pii.PATTERN_SCORE}
    return {(k, kinds[score[own].index(max(score[own]))], a, b) for k, kind, a, b, own, patterns in every if kind == "candidate" and sum(score.get(own, [0])) >= pii.INSTANCE_SCORE and sure & set(patterns)}


@pytest.mark.parametrize("limit", [500_000, 0])
def test_added_spans_match_brute_force(spark, table, monkeypatch, limit):
    monkeypatch.setattr(pii, "BROADCAST_PATTERNS", limit)
    rows = scattered(random.Random(8), 12)[0]
    rows += [(1000 + k, t) for k, t in enumerate(HARD) if len(t) < 2000] + [(2000, None), (2001, ""), (2002, rows[0][1]), (2002, rows[0][1])]
    got = Counter((r.doc_id, m.kind, m.start, m.end) for r in pii.extract(table(rows)).collect() for m in r["more"])
    want = Counter((rows[k][0], kind, a, b) for k, kind, a, b in bootstrapped([t for _, t in rows]))
    assert got == want and len(want) > 20


def test_clashing_columns(spark, table):
    df = table(scattered(random.Random(9), 6)[0]).withColumnsRenamed({"lang": "Base", "source": "row", "n_chars": "a`b-c"})
    out = pii.extract(df, kept=tuple(df.columns))
    assert out.columns == ["doc_id", "text", "row", "a`b-c", "base", "more"]
    assert out.count() == df.count()


def test_empty_table(spark, folder):
    assert queries.op2_personal_data(spark, folder([])).count() == 0
