import random
import re

import pytest
from pyspark.sql import functions as F

from cadastra.llm import pii
from cadastra.llm.pii import address_lines, all_spans, base_spans, decode, find_pii, luhn, masked, regions, train, training_lines


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_base_matches_the_patterns(seed):
    r = random.Random(seed)
    parts = ["@", ".", "..", "a", "b.c", "é", "🙂", " ", "-", "+", "+1", "(", ")", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "007.1.2.3", "x@y.z", "x@y", "%", "12", "9" * 14, "\n", "_"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randrange(1, 14)))
        assert base_spans(t) == plain(t), t


def test_field_finds_held_out_spans():
    weight, hit, said, there = train(), 0, 0, 0
    for text, spans in training_lines(seed=12345, n=500) + address_lines(seed=54321, n=200):
        got = decode(text, weight)
        hit, said, there = hit + len(set(got) & set(spans)), said + len(got), there + len(spans)
    assert hit / there > 0.97 and hit / said > 0.97


def test_added_spans_and_clean_text():
    text = "Call (555) 234-5678 or write joe [at] example [dot] org; cards 4316522678525456 4316522678525456 end"
    base, both = all_spans(text, train())
    assert base == [] and {(k, text[a:b]) for k, a, b in both} == {
        ("phone", "(555) 234-5678"), ("email", "joe [at] example [dot] org"), ("card", "4316522678525456")}
    assert len(both) == 4
    for clean in ("In 2024 we sold 1,204 items for 3.50 each, id 24be64439e3e49cf46b2d7c90f3602a3", "section 3.1.4 of 12.03.2019 (1998)"):
        assert all_spans(clean, train()) == ([], [])
    spans = pii._ordered(both)
    assert "234" not in masked(text, spans) and masked(text, spans).count("<card>") == 2 and masked("é x", "") == "é x"


def test_addresses_are_scored():
    weight = train()
    for text, want in [
        ("mail: anna.b [at] firma [dot] de today", ["anna.b [at] firma [dot] de"]), ("k.o(at)sub(dot)web(dot)org", ["k.o(at)sub(dot)web(dot)org"]),
        ("we were (at) home. Then it rained", []), ("look (at) noon.this", []), ("sold (at) least 3.50 each", []),
        (f"{'a' * 100} (at) {'b' * 80} (dot) com", [f"{'a' * 100} (at) {'b' * 80} (dot) com"]),
    ]:
        assert [text[a:b] for _, a, b in decode(text, weight)] == want, text


def best_by_trial(n, segs, weight):
    """The best segmentation's score, by trying all of them."""
    def go(j, before):
        if j == n:
            return 0.0
        tries = [weight.get(f"{before}>O", 0.0) + go(j + 1, "O")]
        for s in segs:
            if s[0] == j:
                tries.append(sum(weight.get(f, 0.0) for f in s[3]) + weight.get(f"{before}>{s[2]}", 0.0) + go(s[1], s[2]))
        return max(tries)

    return go(0, "")


def test_decoding_is_the_best_of_all_segmentations():
    weight, r = train(), random.Random(3)
    for _ in range(150):
        text = "x " + "".join(r.choice(["12", "345", "6789", "4111", "1111"]) + r.choice([" ", "-", ".", ") ", " ("]) for _ in range(r.randrange(2, 9))) + "7"
        for n, segs in regions(text):
            picked = {(s[2], s[4], s[5]): s for s in segs}
            path, j, before, score = sorted((picked[x] for x in decode(text, weight) if x in picked), key=lambda s: s[0]), 0, "", 0.0
            while j < n:
                s = next((s for s in path if s[0] == j), None)
                label = s[2] if s else "O"
                score += weight.get(f"{before}>{label}", 0.0) + (sum(weight.get(f, 0.0) for f in s[3]) if s else 0.0)
                j, before = (s[1] if s else j + 1), label
            assert abs(score - best_by_trial(n, segs, weight)) < 1e-9, text


def test_long_texts_are_linear():
    for piece in ("a", "1", "1 ", "1.", "(", "+", "@", "a@", "+1 ", "1-", "a.b@c.", "a(at)", "a (at) b.", "(at) b (dot) "):
        all_spans(piece * (400_000 // len(piece)), train())
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_query(spark):
    rows = [(1, "é a@b.co 1.2.3.4"), (2, None), (3, ""), (None, "+1 (659) 555-3949"), (1, "é a@b.co 1.2.3.4"), (4, "w " * 200_000 + "a@b.co")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("t", F.lit(1))
    got = sorted((tuple(r) for r in find_pii(docs).collect()), key=str)
    assert got == sorted(
        [(1, 1, 1, 0, 0, "email:2:8,ip:9:16", "email:2:8,ip:9:16")] * 2
        + [(2, 0, 0, 0, 0, "", ""), (3, 0, 0, 0, 0, "", ""), (None, 0, 0, 0, 1, "phone:0:17", "phone:0:17"), (4, 1, 0, 0, 0, "email:400000:400006", "email:400000:400006")],
        key=str,
    )
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0
