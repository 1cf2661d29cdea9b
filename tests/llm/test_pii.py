"""Base spans against plain patterns, and what contexts add."""

import random
import re
import time

import pytest
from riskloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = {k: [m.span() for m in re.finditer(p, text)] for k, p in PLAIN.items()}
    out["ip"] = [s for s in out["ip"] if all(int(p) <= 255 for p in text[slice(*s)].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", text[slice(*s)])

    def valid(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0

    out["card"] = [s for s in out["card"] if 16 <= len(digits(s)) <= 19 and valid(digits(s))]
    out["phone"] = [s for s in out["phone"] if 8 <= len(digits(s)) <= 15]
    return out


def test_base_against_plain_patterns():
    rng = random.Random(1)
    parts = ["a@b.c", "x.y@", "@", "@z.q.w", "1.2.3.4", "300.1.1.1", ".5", "4111111111111111", "4111-1111 1111 1111", "+1 (017) 555-7713", "+", "-", " ", "é", "12", "a", "%", "..", "\n", "0000256.1.1.1", "1.2.3.4.5.6.7.8"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300000, "1" * 300000, "a@" * 100000, "1." * 100000, "+1" * 100000, "+1 " + "(" * 300000, "1-" * 100000])
def test_very_long_runs_are_linear(text):
    pii.base_spans(text)


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "ab1," * 250_000, "a@b.cd," * 40_000, "x " * 200_000, "a" * 400_000 + " 1", "9 " * 100_000, "a1\u00a0" * 200_000])
def test_occurrences_in_very_long_texts_are_linear(text):
    start = time.process_time()
    pii.occurrences(text, pii.base_spans(text))
    assert time.process_time() - start < 8


def plain_occurrences(text, base):
    """All words with a digit that touch no span, and all spans, with the words before them taken from the whole text before."""
    def context(start):
        near = [re.sub("[0-9]", "0", w[-64:].lower()) for w in re.findall(r"[^\x20\x09-\x0D]+", text[:start])[-2:]]
        return [f"1 {near[-1]}", f"2 {' '.join(near)}"] if len(near) == 2 else [f"1 {w}" for w in near]

    known = sorted((a, b, k) for k, found in base.items() for a, b in found)
    out = [(k, text[a:b].lower(), a, b, context(a)) for a, b, k in known]
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        if re.search("[0-9]", m.group()) and not any(a < m.end() and m.start() < b for a, b, _ in known):
            core = m.group().strip(pii.EDGES)
            if core:
                start = m.start() + m.group().index(core)
                out.append((None, core.lower(), start, start + len(core), context(m.start())))
    return out


def test_occurrences_against_a_plain_scan():
    rng = random.Random(2)
    parts = ["a@b.cd", "tel:", "x" * 70, "id 77-12", "1.2.3.4", " ", "\n", "(9)", "é7", ",,", "no", "+1 (017) 555-7713", "\u00a08", "A1b2", '"'] + [" "] * 6
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        base = pii.base_spans(text)
        assert pii.occurrences(text, base) == plain_occurrences(text, base), text


def test_contexts_behind_very_long_words(docs):
    """A word of a thousand characters before the label: both words of the context are seen."""
    rows = [(i, f"{'w' * 1000}{i} tel: +1 (20{i}) 555-010{i}") for i in range(5)] + [(9, f"{'w' * 1000} tel: 0171-5550199")]
    assert [s[0] for s in spans(pii.find_pii(docs(rows)).collect())[9]] == ["phone"]


def test_clashing_columns(docs):
    names = ["text id", "text size", "extra spans", "base", "id", "size", "kind", "pattern", "start", "new"]
    df = docs([(1, "me@x.org", *names)], "doc_id long, text string" + "".join(f", `{n}` string" for n in names))
    (row,) = pii.find_pii(df).collect()
    assert tuple(row)[2:-1] == tuple(names) and len(row.pii.spans) == 1
    assert pii.redact(df).columns == df.columns


def plain_patterns(edges, rounds=3, support=3, confidence=0.8):
    """The scored graph in dictionaries."""
    kinds = {}
    for _, i, k in edges:
        if k is not None:
            kinds[i] = min(k, kinds.get(i, k))
    below = {}
    for p, i, _ in edges:
        below.setdefault(p, set()).add(i)
    unknown = {(p, i) for p, i, _ in edges} - {(p, i) for p, i, k in edges if k is not None}
    scores = {i: (k, 1.0) for i, k in kinds.items()}
    for turn in range(rounds):
        trusted = {}
        for p, instances in below.items():
            sums = {}
            for i in instances & scores.keys():
                sums[scores[i][0]] = sums.get(scores[i][0], 0.0) + scores[i][1]
            s, n = sum(sums.values()), len(instances)
            if sums and s >= support and s >= confidence * n:
                trusted[p] = max((w, k) for k, w in sums.items())[1], min(s / (n + 1), 0.999)
        if turn + 1 < rounds:
            new = {}
            for p, i in unknown:
                if p in trusted:
                    new.setdefault(i, []).append(trusted[p])
            scores = {i: (k, 1.0) for i, k in kinds.items()}
            for i, found in new.items():
                miss = 1.0
                for _, t in found:
                    miss *= 1 - t
                scores.setdefault(i, (max((t, k) for k, t in found)[1], 1 - miss))
    return {p: k for p, (k, _) in trusted.items()}


def test_learnt_patterns_against_plain_dictionaries(spark):
    rng = random.Random(5)
    found = 0
    for _ in range(4):
        edges = []
        for i in range(60):
            kind = rng.choice([None, None, "email", "phone"])
            for _ in range(rng.randrange(1, 4)):
                edges.append((f"p{rng.choice('aaabbbcdefgh')}{kind or rng.choice(['email', 'phone', 'x'])}", f"i{i}", kind))
        df = spark.createDataFrame(edges + edges[:9] + [(None, "i1", "email"), ("p", None, None)], "pattern string, instance string, kind string")
        want = plain_patterns(edges)
        assert {r.pattern: r.kind for r in pii.learn_patterns(df).collect()} == want
        found += len(want)
    assert found > 10


def spans(rows):
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii.spans] for r in rows}


def test_trusted_contexts_find_more(docs):
    rows = [(i, f"please call tel: +1 (20{i}) 555-010{i} now") for i in range(5)]
    rows += [(10, "please call tel: 0171-5550199, thanks"), (11, "in the year: 1999-01-01"), (12, "Call tel: none"), (10, "call tel: 0171-5550199")]
    got = pii.find_pii(docs(rows)).collect()
    assert len(got) == len(rows)
    found = spans(got)
    assert found[0] == [("phone", 17, 34)] and found[11] == [] and found[12] == []
    assert all(s[0] == "phone" for s in found[10]) and len(found[10]) == 1
    texts = {r.doc_id: r.text for r in pii.redact(docs(rows)).collect()}
    assert texts[0] == "please call tel: [PHONE] now" and texts[11] == rows[6][1]
    assert "0171" not in texts[10]


def test_contexts_of_mixed_tokens_are_not_trusted(docs):
    rows = [(i, f"of the +1 (20{i}) 555-010{i} now") for i in range(5)] + [(20 + i, f"of the 19{i}9-12-31") for i in range(5)]
    assert all(not v for k, v in spans(pii.find_pii(docs(rows)).collect()).items() if k >= 20)


def test_edges(docs):
    rows = [(None, "a@b.cd", "x"), (1, None, "y"), (1, "", "z"), (1, "", "z")]
    df = docs(rows, "doc_id long, text string, found string")
    got = pii.find_pii(df).collect()
    assert sorted(len(r.pii.spans) for r in got) == [0, 0, 0, 1]
    assert sorted(map(str, (tuple(r) for r in pii.redact(df).collect()))) == sorted(map(str, [(None, "[EMAIL]", "x"), *rows[1:]]))
    assert pii.find_pii(docs([])).collect() == []
    with pytest.raises(ValueError):
        pii.find_pii(df.withColumnRenamed("found", "pii"))
