"""Operators 3, 4, 6, 8 and 10 against plain Python, one text at a time."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargomart.llm import licenses, mixing, pii, simhash, toxicity, vec

from .conftest import LONG, TEXTS

LOWER = re.compile("[A-Z]")


def lower(text):
    return LOWER.sub(lambda m: m.group().lower(), text)


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_word_hashes_tell_words_apart(monkeypatch, block):
    monkeypatch.setattr(vec, "BLOCK_BYTES", block)
    rng = random.Random(5)
    texts = ["".join(rng.choices("aB \né日9\t-x", k=rng.randint(0, 40))) for _ in range(400)] + ["", " "]
    for kind, pattern in ((vec.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (vec.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        of, back = {}, {}
        w = vec.words(texts, kind, (2,))
        for i, t in enumerate(texts):
            found = re.findall(pattern, lower(t))
            assert len(found) == len(w.of(i))
            for x, h in zip(found, w.of(i).tolist()):
                assert of.setdefault(x, h) == h and back.setdefault(h, x) == x


@pytest.mark.parametrize("n", [1, 2, 3])
def test_shingles_are_runs_of_words_within_a_text(n):
    texts = ["a b c d", "", "a b", "b c d", "c", "a b c"]
    h, bounds = vec.shingles(vec.words(texts), n)
    got = [set(h[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    words = [t.split() for t in texts]
    want = [{tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()) for w in words]
    for a, x in zip(got, want):
        for b, y in zip(got, want):
            assert len(a & b) == len(x & y)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), order, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


ODD = [
    "a@b.c.d_e@f.gh %@x.y a@b a@b. @c.d a.b+c@d-e.f-g.h..i",
    "1.2.3.4.5.6.7.8 1..2.3.4 256.1.1.1 0255.1.1.1 1.2.3 000.000.000.255",
    "4111111111111111 4111-1111-1111-1111 4111  1111 1111 1111 4111 1111 1111 1111 5 5 4111-1111-1111-111",
    "+1 (415) 555-0123 +1--2 +123456789 +1234567890 +1 415 555 0123 4111111111111111 ++12 345 678 90-1-",
    "0" * 20_000 + "@" + "1." * 9000,
    "a" * 50_000 + " " + "7 " * 9000 + "@" * 500,
    "\U0001F600 x@y.zz é+1 (415) 555-0123 日10.0.0.1",
    "iban GB82WEST12345698765432 and GB82WEST12345698765433, DE89 3704 0044 0532 0130 00.",
    "my ssn 078-05-1120 but 078-05-1120",
]


def test_personal_data_are_those_of_the_plain_patterns(spark, docs):
    texts = ODD + [t for _, t, _ in TEXTS]
    rng = random.Random(8)
    texts += ["".join(rng.choices(["1", "4", "9", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "255", "é"], k=40)) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.digest(pii.find(df)).collect()}
    for i, t in enumerate(texts):
        want = plain_spans(t)
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (t[:200], want)
        assert [found[i][f"n_{k}"] for k, _ in BASE] == [sum(x.startswith(k) for x in want) for k, _ in BASE]
        assert set(want) <= set(found[i]["spans"].split(",")) | {""}
    assert found[7]["spans"].count("iban") == 2 and found[8]["spans"] == "ssn:7:18"
    assert pii.digest(pii.find(docs)).count() == len(TEXTS)


def test_redaction_leaves_the_rest_as_it_is(docs, no_docs):
    rows = {r["doc_id"]: r for r in pii.redact(docs).collect() if r["doc_id"] not in (None, 9, 11)}
    assert rows[1]["text"].endswith("call me at <PHONE> or mail <EMAIL> now")
    assert rows[10]["text"] == "card <CARD> and 4111111111111112, ip <IP> and 10.0.0.256, iban <IBAN>"
    assert rows[7]["text"] == LONG and rows[4]["text"] is None and rows[10]["n_chars"] == len(rows[10]["text"])
    assert pii.redact(docs).columns == docs.columns and pii.redact(no_docs).count() == 0


@pytest.mark.parametrize(
    "text, n",
    [
        ("SSN: 123-45-6789, 234-56-7890, 345-67-8901", 3),
        ("numbers 123-45-6789 and 234-56-7890 (SSN)", 2),
        ("078-05-1120 (SSN)", 1),
        ("Name | SSN\nAnn Example | 123-45-6789\nBob | 234-56-7890\n" + "Cy " * 40 + "| 345-67-8901", 3),
        ("ssn\n123-45-6789\n234-56-7890", 2),
        ("\U0001F600 123-45-6789 \U0001F600 social security; 234-56-7890", 2),
        ("parts 123-45-6789, 234-56-7890", 0),
        ("123-45-6789" + " x" * 40 + " ssn", 0),
    ],
)
def test_context_counts_on_both_sides_and_along_a_list(spark, text, n):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = pii.find(df).first()["spans"]
    assert [text[x["start"] : x["end"]] for x in spans if x["kind"] == "ssn"] == re.findall("[0-9]{3}-[0-9]{2}-[0-9]{4}", text)[:n]
    assert pii.redact(df).first()["text"].count("<SSN>") == n


def test_redaction_leaves_nothing_of_a_span(spark):
    texts = [
        "call +49 30 123 456 78 or +55 11 912 345 678.", "\U0001F600 +49 30 123 456 78\U0001F600x@y.zz", "DE89 3704 0044 0532 0130 00",
        "GB33 4111 1111 1111 1111 11", "+4111111111111111 and 1.2.3.4@host.org, +1 (415) 555-0123 +1 415 555 0123", *ODD,
    ]
    rng = random.Random(9)
    bits = ["+49 30 123 456 78", "4111 1111 1111 1111", "x@1.2.3.4", "078-05-1120", "ssn ", " ", "-", "é", "7", "DE89 3704 0044 0532 0130 00", "+"]
    texts += ["".join(rng.choices(bits, k=rng.randint(1, 6))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.find(df).collect()}
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert got[0] == "call <PHONE> or <PHONE>." and got[1].startswith("\U0001F600 <PHONE>\U0001F600<EMAIL>")
    for i, text in enumerate(texts):
        gone = {k for x in spans[i] for k in range(x["start"], x["end"])}
        left = re.split("<(?:EMAIL|IP|CARD|PHONE|IBAN|SSN)>", got[i])
        assert "".join(left) == "".join(c for k, c in enumerate(text) if k not in gone), text[:200]


def test_fingerprints_follow_the_documents(docs, no_docs):
    got = simhash.along(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next").collect()
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()), reverse=True)
    texts = [t or "" for _, t, _ in order]
    want = []
    for k, (doc_id, _, _) in enumerate(order):
        edited = simhash.edit(texts[k], texts[(k + 1) % len(texts)])
        a, b, c = simhash.fingerprints([texts[k], edited, texts[(k + 1) % len(texts)]])
        sha = hashlib.sha256(edited.encode()).hexdigest()
        want.append((doc_id, len(texts[k]), sha, int(a.view(np.int64)), float(simhash.likeness(a, b)), float(simhash.likeness(a, c))))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash.along(no_docs).count() == 0


def test_a_single_document_is_next_to_itself(spark):
    r = simhash.along(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0


def test_all_fingerprints_within_the_radius_are_found(spark):
    rng = np.random.default_rng(1)
    prints = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 60)]
    for p in prints[:30]:
        flips = rng.choice(64, rng.integers(1, 6), replace=False)
        q = p & ((1 << 64) - 1)
        for f in flips:
            q ^= 1 << int(f)
        prints.append(q - (1 << 64) if q >> 63 else q)
    df = spark.createDataFrame([(p,) for p in prints + prints[:9] + [None]], "fingerprint long")
    apart = lambda a, b: bin((a ^ b) & ((1 << 64) - 1)).count("1")
    want = {(a, b, apart(a, b)) for a in prints for b in prints if apart(a, b) <= 3}
    got = [tuple(r) for r in simhash.within(df, df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_license_places_are_those_of_the_words(docs, no_docs):
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(TEXTS) and licenses.scan(no_docs).count() == 0
    by_text = {}
    for doc_id, text, _ in TEXTS:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        hits = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        first, last = (min(hits)[0], max(hits)[0]) if hits else (None, None)
        by_text.setdefault(doc_id, []).append((len(w), len(hits), first, last, ",".join(sorted({x for _, x in hits}))))
    for r in rows:
        assert tuple(r)[1:6] in by_text[r["doc_id"]] and 0 <= r["score"] <= 1
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(","))


@pytest.mark.parametrize(
    "template, text, length",
    [
        ("a b c", "a b c d", 3),
        ("a b c", "a b d", 0),
        ("a [[b]] c", "a c", 2),
        ("a [[b [[x]] y]] c", "a b y c", 4),
        ("a {2} c", "a q q c", 4),
        ("a {2} c", "a q q q c", 0),
        ("a {1}", "a q q", 2),
        ("[[a]] b", "b", 1),
    ],
)
def test_automata_accept_the_wording(template, text, length):
    a = licenses.compile_template("x", template)
    words = {w for s in a.step for w in s}
    number = {w: i for i, w in enumerate(sorted(words))}
    assert a.match([number.get(w, -1) for w in text.split()], number) == length


def test_license_wording_with_regions(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "licensed under the terms of the general public license version 2",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "The MIT License\nCopyright (c) 2020 Some One\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the 'Software'), to deal in the Software without restriction",
        "licensed under nothing",
    ]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["gpl-3", "gpl-2", "cc-by-nc", "", ""]
    assert [r["partial"] for r in got] == ["", "", "", "mit", ""]
    assert got[0]["score"] > got[3]["score"] == got[4]["score"] == 0


MIT = """MIT License\n\nCopyright (c) 2020 Some One\n
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""


def test_license_bodies_count_to_their_end():
    of = lambda t: licenses._scan([t])[0][-3:-1]
    whole = of(MIT + " And more text.")
    assert whole[0] == "mit" and whole[1] > of("licensed under the MIT License")[1] > 0
    for cut in (MIT[:700], MIT[: MIT.index(", including")], MIT.rsplit(" ", 1)[0]):
        assert licenses._scan([cut])[0][-3:] == ("", 0.0, "mit")
    for old, new in (
        ("subject to", "for good and not evil, subject to"), ("sell copies", "rent copies"), ("LIABLE FOR ANY", "LIABLE FOR SOME"),
        (MIT[MIT.index("The above") : MIT.index("THE SOFTWARE")], ""), ("without restriction", "without restriction except war"),
    ):
        assert old in MIT and of(MIT.replace(old, new) + " And more text.") == ("", 0.0)
    for label, ts in licenses.TEMPLATES.items():
        for t in ts:
            text = re.sub(r"\{[0-9]+\}", "x", re.sub(r"\[\[|\]\]|\|\|", "", t)) + " y z"
            assert label in of(text)[0].split(",")
            if "||" in t:
                words = text.split()
                words[len(words) // 2] += "q"
                assert label not in of(" ".join(words))[0].split(",")


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weigh = {s: weights[i % 3] for i, s in enumerate(names)}
    out, rest, left = {}, 1.5 * sum(sizes.values()), set(names)
    while left:
        level = rest / sum(weigh[s] for s in left)
        over = {s for s in left if weigh[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: weigh[s] * level for s in left}
        out |= {s: 2.0 * sizes[s] for s in over}
        rest -= sum(2 * sizes[s] for s in over)
        left -= over
    return out


@pytest.mark.parametrize("group", [3, 10_000])
def test_the_mix_meets_its_targets(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group)
    monkeypatch.setattr(mixing, "STEPS", 7)
    rng = random.Random(2)
    names = ["a", "b", "é", "Z", None, "\U0001F600", "zero"]
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 9))), rng.choice([*names[:-1], "a", "a", "a"])) for i in range(600)]
    rows += [(i, None if i % 2 else " ", "zero") for i in range(600, 604)] + [rows[0], rows[1], (None, "some words", "b")]
    df = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {s: sum(words(t) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 9
    assert 1.5 * sum(sizes.values()) - 9 <= sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    applied = mixing.apply_mix(df, mixing.mix(df))
    assert applied.columns == df.columns
    assert applied.select(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(taken.values())


def test_nothing_to_mix(no_docs, spark):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r["target"], r["taken"]) for r in mixing.mix(blank).collect()} == {(0.0, 0)}


def toxic_rows(n, seed):
    rng = random.Random(seed)
    calm, bad = [f"word{k}" for k in range(200)], ["grumble", "grumbled", "grumbling", "snarler"]
    rows, labels = [], []
    for i in range(n):
        sentences = [rng.choices(calm, k=rng.randint(2, 9)) for _ in range(rng.randint(1, 9))]
        if toxic := i % 6 == 0:
            rng.choice(sentences).insert(1, rng.choice(bad))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", "x"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart_and_sentences_located(spark):
    rows, labels = toxic_rows(900, 4)
    rows += [(9001, "", "x"), (9002, None, "x"), (9003, "calm. \U0001F600 é grumbled word1. calm", "x"), (None, "word1 word2", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1), (2, 0, 7), (0, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(df, known)
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    truth = {i: y for i, _, y in labels}
    right = sum((got[i]["score"] >= 0.5) == bool(y) for i, y in truth.items())
    assert right >= 0.98 * len(truth)
    assert got[9001]["score"] == got[9002]["score"] == 0.0
    (place,) = got[9003]["offending"]
    assert rows[-2][1][place["start"] : place["end"]] == "\U0001F600 é grumbled word1"
    assert max(r["score"] for r in got.values()) <= 1 and min(r["score"] for r in got.values()) >= 0


def test_without_labels_of_both_kinds_nothing_is_toxic(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("toxic = 5")):
        model = toxicity.train(docs, known)
        scores = [r["score"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect()]
        assert len(scores) == len(TEXTS) and max(scores) < 1e-9
    assert toxicity.score(no_docs.select("doc_id", "text"), model).count() == 0
