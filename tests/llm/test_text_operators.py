"""Operators 1, 2, 4, 5 and 10 on awkward inputs, against plain Python."""

import hashlib
import json
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from ledgerloom.llm import chat_format, pii, quality, token_counts, toxicity

DOCS = "doc_id long, text string, lang string, source string, pii string, score double"


def docs(spark, texts):
    """Rows with a column or two whose names clash with results."""
    return spark.createDataFrame([(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "s", "x", 2.0) for i, t in enumerate(texts)], DOCS)


def test_toxicity_learns_held_in_labels_only(spark):
    ids = range(400)
    texts = [("plain words about rivers and hills " * (1 + i % 3)) + ("you worthless moron " if i % 4 == 0 else "") for i in ids]
    d = docs(spark, [*texts, None, "", "moron " * 20000])
    labels = spark.createDataFrame([(i, int(i % 4 == 0) ^ int(zlib.crc32(str(i).encode()) % 5 == 0)) for i in ids], "doc_id long, toxic int")
    got = toxicity.scored(d, labels).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(got) == 403
    by = {r.doc_id: r for r in got}
    # held-out labels are planted wrong: a model that had learned from them would follow them
    assert all(by[i].predicted == int(i % 4 == 0) for i in ids)
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in ids)
    assert by[402].predicted == 1 and 0 <= by[400].score <= 1 and by[400].score == by[401].score
    assert toxicity.scored(d.limit(0), labels.limit(0)).count() == 0
    assert {r.predicted for r in toxicity.scored(d.limit(3), labels.limit(0)).collect()} == {0}


def plain_fit(texts, y, sizes=(3, 4, 5)):
    """Scores of a plain classifier: distinct n-grams, log-count ratios with one added, balanced penalised logistic loss
    minimised by many small steps; grams in one document and with ratios below 0.7 don't count."""
    grams = [{t[i:i + n] for t in [f" {' '.join(x.lower().split())} "] for n in sizes for i in range(len(t) - n + 1)} for x in texts]
    names = sorted(set().union(*grams))
    x = np.array([[n in g for n in names] for g in grams], float)
    y = np.array(y, float)
    p, q = x[y == 1].sum(axis=0), x[y == 0].sum(axis=0)
    ratio = np.log((p + 1) / (p.sum() + toxicity.BUCKETS)) - np.log((q + 1) / (q.sum() + toxicity.BUCKETS))
    keep = (np.abs(ratio) > 0.7) & (p + q > 1)
    x = x[:, keep] * ratio[keep]
    balance = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    step = 1 / (0.25 * (np.linalg.norm(x, 2) ** 2 + len(y)) * balance.max() / len(y) + toxicity.PENALTY)
    for _ in range(60_000):
        err = balance * (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        w, b = w - step * (x.T @ err + toxicity.PENALTY * w), b - step * err.sum()
    return 1 / (1 + np.exp(-(x @ w + b)))


def test_toxicity_scores_equal_a_plain_fit(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 2000)
    r = np.random.default_rng(4)
    polite, rude = [f"kind{i}" for i in range(12)], [f"vile{i}" for i in range(6)]
    rows = [(i, " ".join([*r.choice(polite, 5), *(r.choice(rude, 2) if i % 3 == 0 else r.choice(polite, 1))])) for i in range(90)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    y = [int(i % 3 == 0 or i == 1) for i, _ in rows]  # one label of the other class
    got = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"),
                          spark.createDataFrame([(i, k) for (i, _), k in zip(rows, y, strict=True)], "doc_id long, toxic int"))
    got = {x.doc_id: x.score for x in got.collect()}
    want = plain_fit([t for _, t in rows], y)
    assert max(abs(got[i] - s) for (i, _), s in zip(rows, want, strict=True)) < 0.02


def test_repeated_ids_keep_the_sample_bounded(spark):
    d = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, None), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0)], "doc_id long, toxic int")
    got = {r.doc_id: (r.text, r.toxic) for r in toxicity.training_sample(d, labels).collect()}
    assert got == {1: ("text 0", 0), 2: ("b", 1)}


def test_the_fit_is_bounded_by_its_most_telling_buckets(spark, monkeypatch):
    rows = [(i, f"common words {i} " + ("dreadful insult " if i % 2 else "pleasant greeting ")) for i in range(80)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MAX_ENTRIES", 200)
    weights, _ = toxicity.fit(d, labels)
    assert 0 < np.count_nonzero(weights) <= 10
    assert {(x.doc_id % 2, x.predicted) for x in toxicity.scored(d, labels).collect()} == {(0, 0), (1, 1)}


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts_and_outliers(spark):
    clean = [" ".join(f"word{(i * 7 + j) % 97} and" for j in range(15 + i % 20)) + "." for i in range(120)]
    junk = [" ".join("zz***" + "$" * (j % 4) for j in range(i + 25)) for i in range(5)]
    odd = [None, "", " \t\n", "a b c d e f g h " * 300, "é😀 x\n\nx\nx", "one two three four five six seven eight", "w " * 30000]
    texts = clean + junk + odd
    got = {r.doc_id: r for r in quality.judged(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(t), i
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert all(got[i].kept for i in range(len(clean)) if not got[i].base_failed)
    assert not any(got[i].kept for i in range(len(clean), len(texts)))
    assert quality.judged(docs(spark, texts).limit(0)).count() == 0


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, " ", "  a", "a  b ", "\n\n x\n", "▁a▁", "</s> <unk>", "end. End, x...\nNext!", "é 中文 😀\x00", "x" * 5000, "a " * 3000, "the same", "the same"]
    got = {r.doc_id: r for r in token_counts.token_counts(docs(spark, texts), path).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == [len(sp.encode(t or "")) for t in texts]
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert token_counts.token_counts(docs(spark, texts).limit(0), path).count() == 0


def test_rare_pre_tokens_are_joined(spark, monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    monkeypatch.setattr(token_counts, "HEAD", 1)
    d = docs(spark, ["one two one three", "two unbelievable", "one"])
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(d, path).collect()} == {
        r.doc_id: len(sp.encode(r.text)) for r in d.collect()}


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\n$1 <<s> <<SYS>>x<</SYS>> \\[INST] [\\INST]", "", "é😀\n<s>", "[[INST]]</s></s>", "y" * 50000]


def test_chat_round_trip(spark):
    records = [json.dumps({"messages": [{"role": "user", "content": t}, {"role": "assistant", "content": t}]}) for t in HARD]
    records += [json.dumps({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}),
                json.dumps({"instruction": "i", "input": "x", "context": "c", "output": "o"}), json.dumps({"prompt": "p", "completion": "c"}),
                "{}", "[1]", "x{", None, json.dumps({"messages": []}), json.dumps({"messages": [{"role": None, "content": None}]})]
    d = spark.createDataFrame([(i, r, "x") for i, r in enumerate(records)], "conv_id long, record string, turns string")
    rows = chat_format.formatted(chat_format.canonical(d)).withColumns({
        "back": chat_format.read_back(F.col("formatted")), "loss": chat_format.loss_text(F.col("formatted"), F.col("loss_spans"))}).orderBy("conv_id").collect()
    for i, t in enumerate(HARD):
        assert [x.text for x in rows[i].back] == [t, t] and rows[i].loss == t
    n = len(HARD)
    assert [(x.role, x.text) for x in rows[n].back] == [("user", "a"), ("assistant", "b")]
    assert [x.role for x in rows[n + 1].turns] == ["system", "user", "user", "assistant"]
    assert [rows[i].layout.mapping for i in range(n, len(records))] == ["sharegpt", "instruction", "prompt", None, None, None, None, "messages", "messages"]
    assert rows[-2].formatted == "" and rows[-1].back == rows[-1].turns


def test_fingerprints_tell_layouts_apart():
    marks = [chat_format.fingerprint(s) for m in chat_format.MAPPINGS for s in m.path_sets()]
    assert len(set(marks)) == len(marks)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


PII_TEXTS = ["a@b.cd@e.fg x", "a@b.c%d@e.f", "a.b@c..d", "é😀 a@b.co +1 (234) 555-1234 99", "1.2.3.4.5.6.7.8", "256.1.1.1 0.0.0.0 00255.1.2.3",
             "4111 1111 1111 1111 4111-1111-1111-1112", "+1 2", "", None, "x" * 20000 + "@" + "a.b" * 5000, "1 " * 9000, "+" * 500 + "1.1.1.1",
             "4111111111111111", "99  4111 1111 1111 1111", "1.2.3.4@x.yz", "1.2.3.4@x.yz"]


def test_base_spans_equal_plain_search(spark):
    rows = pii.with_spans(docs(spark, PII_TEXTS)).orderBy("doc_id").collect()
    for r, t in zip(rows, PII_TEXTS, strict=True):
        want = sorted((m.start(), i, k, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, t or "") if valid(k, m.group()))
        assert [(s.start, s.order, s.kind, s.end) for s in r.pii if s.kind in PATTERNS] == want


def test_checksums_context_and_redaction(spark):
    texts = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013001", "my ssn is 123-45-6789", "order 123-45-6789", "mail a@b.co or 1.2.3.4", None]
    d = docs(spark, texts)
    spans = [[s.kind for s in r.pii] for r in pii.with_spans(d).orderBy("doc_id").collect()]
    assert spans == [["iban"], [], ["ssn"], [], ["email", "ip"], []]
    assert [r.text for r in pii.redacted(d).orderBy("doc_id").collect()] == [
        "[IBAN]", "DE89370400440532013001", "my ssn is [SSN]", "order 123-45-6789", "mail [EMAIL] or [IP]", None]
    assert pii.with_spans(d.limit(0)).count() == 0


def test_iban_before_other_words(spark):
    one, other = "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19"
    after = ["Please pay", "Bitte", "12 May", "BIC COBADEFFXXX", other, "on time", ", 5", "A"]
    texts = [f"{code} {a}" for code in (one, one.replace(" ", "")) for a in after] + [f"AT12 {one} X", f"é😀 {one} Bitte", f"{one}X", f"NO93 8601 1117 947 IBAN {one}"]
    rows = pii.with_spans(docs(spark, texts)).orderBy("doc_id").collect()
    got = [[t[s.start:s.end] for s in r.pii if s.kind == "iban"] for t, r in zip(texts, rows, strict=True)]
    want = [[code, other] if a == other else [code] for code in (one, one.replace(" ", "")) for a in after]
    assert got == [*want, [one], [one], [], ["NO93 8601 1117 947", one]]
    assert pii.redacted(docs(spark, [f"{one} Bitte"])).first().text == "[IBAN] Bitte"


def test_context_on_both_sides(spark):
    bad, bad_at = "DE89 3704 0044 0532 0130 01", "AT61 1904 3002 3457 3202"
    texts = ["123-45-6789 is my SSN", "123-45-6789 é social security", "ssn 123-45-6789, order 7", "order 123-45-6789", "123-45-6789 " + "x " * 40 + "ssn",
             "666-45-6789 is my SSN", f"{bad} is my IBAN", f"Konto {bad_at}", f"{bad} sent", "account XX61 1904 3002 3457 3202"]
    rows = pii.with_spans(docs(spark, texts)).orderBy("doc_id").collect()
    assert [[s.kind for s in r.pii] for r in rows] == [["ssn"], ["ssn"], ["ssn"], [], [], [], ["iban"], ["iban"], [], []]


def test_base_digest_of_query(spark, tmp_path):
    docs(spark, PII_TEXTS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.query(spark, str(tmp_path)).collect()}
    assert got[8].base_sha256 == hashlib.sha256(b"").hexdigest() and got[8].spans == ""
    assert got[13].base_sha256 == hashlib.sha256(b"card:0:16").hexdigest() and got[13].n_card == 1


def plain_mcd(x):
    """Squared distances by concentration steps on the exact 75 % of the rows."""
    x = np.array(x, float)
    q = np.percentile(x, [25, 50, 75], axis=0)
    floor = np.diag((np.array(quality.FLOORS) * quality.UNIT) ** 2)
    mean, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor
    for step in range(quality.STEPS + 1):
        d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        if step < quality.STEPS:
            half = x[np.argsort(d2, kind="stable")[:int(np.ceil(quality.SHARE * len(x)))]]
            mean, cov = half.mean(axis=0), np.cov(half.T, bias=True) * quality.CONSISTENCY + floor
    return d2


def test_outliers_equal_plain_mcd(spark):
    rows = quality.with_groups(quality.statistics(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).toPandas()
    got = quality.judged(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas().set_index("doc_id").kept
    rows = rows[~rows.base_failed]
    assert rows.grp.nunique() > 1
    want = {}
    for _, g in rows.groupby("grp"):
        want.update(zip(g.doc_id, plain_mcd(g[quality.STATS]) <= quality.CUT, strict=True) if len(g) >= 10 else zip(g.doc_id, [True] * len(g), strict=True))
    assert len(got) == 1000 and 0 < sum(not v for v in want.values()) < 200
    # bins of distances move the 75 % point by less than a bin: verdicts may differ on the very edge only
    assert sum(got[i] != v for i, v in want.items()) <= 2


def test_chat_query_equals_the_rows(spark, tmp_path):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 2, "user", "</s>"), (3, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in chat_format.query(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 3, -7}
    assert got[2].turns_sha256 == hashlib.sha256(b"system\ns\nassistant\nb\nuser\n</s>\n").hexdigest() and got[2].n_turns == 3
    assert got[1].loss_chars == 0 and got[2].loss_sha256 == hashlib.sha256(b"b").hexdigest()
    assert got[-7].loss_chars == len(HARD[0]) and got[3].n_turns == 1
