"""Every operator against its contract in plain Python, on tricky and on given rows."""

import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citeloom.llm import decontaminate, language, licenses, line_dedup, near_dup, packing, quality, secrets, suffix_dedup, token_files, tokens
from tests.llm import brute
from tests.llm.rows import tricky_rows

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def got(df, *cs):
    return sorted((tuple(r) for r in df.select(*cs).collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(params=["tricky", "repeated", "none", "small"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_secrets(docs):
    out = secrets.find_secrets(docs)
    assert got(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want((d, *brute.secrets(t)) for d, t in pairs(docs))


def test_secrets_network_holds_the_recall_of_every_shape():
    network = secrets.train([])
    x, y, shapes = secrets.built_findings([], 4000, seed=9)
    over = network.probability(x) >= np.array(network.thresholds)[shapes]
    for shape in (1, 2):
        assert over[(y > 0) & (shapes == shape)].mean() >= secrets.RECALL - 0.01
    assert over[y == 0].mean() < 0.02
    assert network.thresholds[0] > 1  # digits alone are never taken for a key


def test_secrets_every_stretch_of_a_long_run_is_seen():
    text = "x " + "z1" * 200
    (start, end, kind, _, windows, _), = secrets.candidates(text.encode())
    assert (start, end, kind) == (2, 402, "")
    shown = np.frombuffer(windows, np.uint8).reshape(-1, secrets.WINDOW)[:, secrets.BEFORE : secrets.BEFORE + secrets.INSIDE]
    assert len(shown) == 14 and (shown > 0).all()
    assert [c[:2] for c in secrets.candidates(b"aBcDeFgHiJkLm plainlongword token: zzzzzzzzzzzzz")] == [(28, 48), (0, 13)]


def test_secrets_finds_planted_keys_of_unknown_formats(spark, small):
    """Formats that are neither patterns nor built for training, in texts of the corpus."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    formats = {"glpat-": 20, "SG.": 66, "npm_": 36, "pk_live_": 24, "hvs.": 40}
    rng = random.Random(8)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [t for _, t in pairs(docs) if t and len(t) > 200][:400]
    rows, places = [(k, t) for k, t in enumerate(texts)], {}
    for n, (prefix, size) in enumerate(formats.items()):
        for k in range(60):
            words = texts[(n * 60 + k) % len(texts)].split(" ")
            at = rng.randrange(1, len(words))
            key = prefix + "".join(rng.choice(letters) for _ in range(size))
            text = " ".join([*words[:at], rng.choice(["key", "use", "", "value"]), key, *words[at:]])
            places[10_000 + n * 60 + k] = (prefix, text.index(key), text.index(key) + len(key))
            rows.append((10_000 + n * 60 + k, text))
    found = {r[0]: (r[1], r[2]) for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "spans", "n_model").collect()}
    for prefix in formats:
        own = [f"model:{a}:{b}" in found[d][0].split(",") for d, (p, a, b) in places.items() if p == prefix]
        assert sum(own) >= 0.9 * len(own), prefix
    # Spans that the network adds to texts without a planted key.
    assert sum(found[k][1] > 0 for k in range(len(texts))) <= 0.01 * len(texts)


def test_quality(docs):
    out = quality.judge(docs)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(out, *names) == want((d, *brute.quality(t)) for d, t in pairs(docs))
    assert out.filter("base_failed AND kept").count() == 0


def test_quality_keeps_clean_documents(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge(docs).join(labels, "doc_id").filter("NOT base_failed")
    assert judged.filter("quality = 1 AND NOT kept").count() == 0
    assert judged.filter("quality = 0 AND kept").count() <= 0.2 * judged.filter("quality = 0").count()
    kept = quality.drop_low_quality(docs)
    assert kept.columns == docs.columns


def test_quality_rejects_long_documents_without_common_words(spark):
    columns = ("doc_id", "text", "lang")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*columns)
    references = quality.References(quality.language_references(docs).collect())
    rng = random.Random(4)

    def salad(words):
        made = ["".join(rng.choice("etaoinsrhldcu") for _ in range(rng.randint(3, 9))) for _ in range(words)]
        made = [w for w in made if w.encode() not in references.place]
        return ". ".join(" ".join(made[k : k + 12]).capitalize() for k in range(0, len(made), 12)) + "."

    odd = spark.createDataFrame([(-1, salad(400), None), (-2, salad(40), None)], "doc_id bigint, text string, lang string")
    out = {r[0]: r[1:] for r in quality.judge(docs.unionByName(odd)).filter("doc_id < 0").select("doc_id", "base_failed", "kept", "character_distance").collect()}
    assert not out[-1][0] and out[-1][2] <= quality.MAX_CHARACTER_DISTANCE and not out[-1][1]
    assert out[-2][1]  # too short to be judged by words


def test_quality_does_not_judge_by_words_where_a_language_has_no_common_ones(spark):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x4E00, 0x4F00)]
    far = [" ".join("".join(rng.choice(letters) for _ in range(8)) for _ in range(90)) for _ in range(40)]
    near = [" ".join(rng.choice(["the", "of", "and", "house", "cat"]) for _ in range(90)) for _ in range(40)]
    rows = [(k, t, lang) for lang, texts in (("zh", far), ("en", near)) for k, t in enumerate(texts, 100 * (lang == "en"))]
    out = quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert out.filter("NOT base_failed AND doc_id < 100 AND NOT kept").count() == 0


@pytest.mark.parametrize(("path", "lower_case"), [(WORD, True), (BYTE, False)])
def test_parts_give_the_ids_of_whole_texts(path, lower_case):
    rng = random.Random(3)
    bits = ["a", "b", "É", "'", "s", " ", "\n", "  ", "\t", "!", "|", "<|endoftext|>", "<|", "ß", "́", "1", "２", "\x1c", " ", "　", "ſ", "K", "İ", "Σ", "don't", "THE", "x" * 80]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(2000)] + [t for _, t in tricky_rows() if t]
    tokenizer = Tokenizer.from_file(path)
    whole = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert tokens.PartEncoder(path, lower_case).encode([t.encode() for t in texts]) == whole


def test_token_files(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs, path, WORD, end_id=2, lower_case=True)
    out = token_files.token_index(spark, path)
    rows = got(out, "doc_id", "start", "n_tokens", "ids_crc32")
    expected = brute.token_rows(pairs(docs), Tokenizer.from_file(WORD), 2)
    # Rows of one id follow each other in some order.
    assert want((r[0], r[2], r[3]) for r in rows) == want((r[0], r[2], r[3]) for r in expected)
    at = 0
    for r in sorted(rows, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]
    ids = [r[0] for r in sorted(rows, key=lambda r: r[1])]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))


def test_token_files_find_documents_by_metadata(spark, tricky, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(tricky, path, WORD, end_id=2, lower_case=True)
    some = token_files.read_token_files(spark, path, [3, 44])
    assert sorted(r[0] for r in some.select("doc_id").collect()) == [3, 44]
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()


def test_near_duplicates(tricky, none, small):
    for docs in (tricky, none, small):
        rows = pairs(docs)
        classes = brute.components(rows)
        expected = [(d, len(brute.shingles(t)), classes[d], classes[d] == d) for d, t in rows]
        assert got(near_dup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want(expected)


def test_near_duplicates_of_repeated_rows(repeated):
    rows = pairs(repeated)
    classes = brute.components([r for r in rows if r[0] is not None])
    expected = [(d, len(brute.shingles(t)), classes.get(d), d is None or classes[d] == d) for d, t in rows]
    assert got(near_dup.near_duplicates(repeated), "doc_id", "n_shingles", "component_id", "kept") == want(expected)
    assert near_dup.drop_near_duplicates(repeated).columns == repeated.columns


def test_near_duplicates_with_a_large_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for doc in range(80):
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 10**6)}"
        rows.append((doc, " ".join(own)))
    classes = brute.components(rows)
    out = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r[0]: r[1] for r in out.select("doc_id", "component_id").collect()} == classes


def test_packing(docs):
    rows = packing.pack_documents(docs, BYTE, end_id=0).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    ids = sorted((np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for _, t in pairs(docs)), key=len)
    assert sum(r.length for r in rows) == sum(len(i) for i in ids) // 4
    by_sequence = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.SEQUENCE_TOKENS
    if len({r.doc_id for r in rows}) == len(pairs(docs)):
        by_doc = {}
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == len(by_doc.setdefault(r.doc_id, b"")) // 4
            by_doc[r.doc_id] += bytes(r.ids)
        assert sorted(by_doc.values(), key=len) == ids or sorted(by_doc.values()) == sorted(ids)


def test_packing_balances_cost_and_pads_little():
    rng = random.Random(1)
    sizes = [rng.randint(1, 900) for _ in range(3000)]
    pieces = packing.pack(sizes)
    used, cost = {}, {}
    for _, _, n, sequence, _ in pieces:
        used[sequence] = used.get(sequence, 0) + n
        cost[sequence] = cost.get(sequence, 0) + packing.LINEAR * n + packing.QUADRATIC * n * n
    assert sum(used.values()) == sum(sizes)
    assert len(used) * 1024 - sum(sizes) < 1024
    values = np.array(sorted(cost.values()))[1:]
    assert values.std() / values.mean() < 0.1


def test_language(spark, docs):
    taught = spark.createDataFrame([("the cat and the dog of the house", "en"), ("der hund und die katze im haus", "de"), ("le chat et le chien de la maison", "fr"), (None, "xx"), ("x", None)], "text string, lang string")
    model = language.learn(taught)
    assert model.languages == ["de", "en", "fr"]
    out = language.predict_languages(docs, model)
    for doc, lang, score in got(out, "doc_id", "lang_pred", "score"):
        assert 0 <= score <= 1 and (lang in model.languages or (lang == "und" and score == 0))
    assert out.count() == docs.count()
    texts = dict(pairs(docs))
    for doc, lang in got(out, "doc_id", "lang_pred"):
        if doc is not None and not any(c.isalpha() for c in texts[doc] or ""):
            assert lang == "und"


def test_language_mixture_and_nothing_learned(spark, none):
    en, de = "the cat and the dog of the house were with him in the garden ", "der hund und die katze sind nicht mit ihm in dem garten des hauses "
    model = language.learn(spark.createDataFrame([(en * 3, "en"), (de * 3, "de")], "text string, lang string"))
    (lang, score, both), (one, full, alone) = model.predict([(en * 6 + de * 3).encode(), de.encode()])
    assert lang == "en" and both == "en,de" and 0.5 < score < 0.8
    assert one == "de" and alone == "de" and full > 0.9
    nothing = language.learn(none)
    assert nothing.predict([b"abc"]) == [("und", 0.0, "")]


def many_languages(n):
    """Texts of ``n`` languages, each with words of its own; the first languages have most documents."""
    rng = random.Random(12)
    rows = []
    for k in range(n):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 7))) for _ in range(12)]
        rows += [(len(rows) + j, " ".join(rng.choice(own) for _ in range(70)), f"l{k:03}") for j in range(3 if k < n - 20 else 2)]
    return rows


def test_language_counts_all_of_many_languages(spark):
    rows = many_languages(230)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.learn(docs)
    assert len(model.languages) == 230
    found = {r[0]: (r[1], r[2], r[3]) for r in language.predict_languages(docs, model).collect()}
    assert all(found[d][0] == lang == found[d][2] for d, _, lang in rows)
    a, b = rows[0], rows[-1]
    (lang, score, both), = model.predict([(a[1] + " " + b[1] + " " + b[1]).encode()])
    assert (lang, both) == (b[2], f"{b[2]},{a[2]}") and 0.6 < score < 0.75


def test_language_does_not_depend_on_blocks_or_what_is_held(spark, monkeypatch):
    rows = many_languages(30)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts = [t.encode() for _, t, _ in rows] + [(rows[k][1] + " " + rows[-1 - k][1]).encode() for k in range(20)] + [None, b"..."]
    whole = language.learn(docs).predict(texts)
    for block, held in ((6, 64 << 20), (6, 0), (200, 0), (1, 0)):
        monkeypatch.setattr(language, "BLOCK", block)
        monkeypatch.setattr(language, "HELD_BYTES", held)
        model = language.learn(docs)
        assert isinstance(model, language.Blocks) == (block < 30)
        found = model.predict(texts)
        assert [(r[0], r[2]) for r in found] == [(r[0], r[2]) for r in whole]
        assert np.allclose([r[1] for r in found], [r[1] for r in whole], atol=1e-4)


def test_language_against_plain_mixtures(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    texts = [t for _, t in pairs(small)[:60]] + [t for _, t in tricky_rows() if t is None or len(t) < 3000]
    texts += [a[:300] + " " + b[:200] for a, b in zip(texts[:30], texts[30:60])]
    found = model.predict([t.encode() if t is not None else None for t in texts])
    for t, (lang, score, names) in zip(texts, found):
        expected = brute.language(t, model, language.ROUNDS, language.MAX_SET, language.PENALTY)
        assert (lang, names) == (expected[0], expected[2]) and abs(score - expected[1]) < 1e-3


def test_language_of_a_very_long_text_is_that_of_its_words(spark):
    en, de = "the cat and the dog of the house were with him in the garden ", "der hund und die katze sind nicht mit ihm in dem garten des hauses "
    model = language.learn(spark.createDataFrame([(en * 3, "en"), (de * 3, "de")], "text string, lang string"))
    short, long = model.predict([(en * 6 + de * 3).encode(), (en * 60_000 + de * 30_000).encode()])
    assert (short[0], short[2]) == (long[0], long[2]) and abs(short[1] - long[1]) < 1e-3


def test_quality_has_a_reference_of_every_language(spark):
    docs = spark.createDataFrame(many_languages(230), "doc_id bigint, text string, lang string")
    references = quality.References(quality.language_references(docs).collect())
    assert len(references.words) == 230
    assert quality.judge(docs).filter("word_distance > 0.5").count() == 0


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_language_on_held_out_documents(spark, small, sf):
    from citeloom.llm import queries

    found = queries.op6_language_id(spark, f"/root/testdata/{sf}")
    truth = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(truth, "doc_id")
    assert right.filter("lang_pred = lang").count() >= 0.98 * right.count()


def items_of(spark, docs):
    rows = [("short", "one two"), ("long", tricky_rows()[1][1][:200]), ("none", None), ("empty", "--"), ("twice", tricky_rows()[2][1][:90]), ("twice", tricky_rows()[3][1][40:150]), (None, "alpha")]
    return spark.createDataFrame(rows, "item_id string, text string"), [r for r in rows if r[0] is not None]


def test_contamination(spark, docs):
    benchmark, items = items_of(spark, docs)
    out = decontaminate.contamination(docs, benchmark)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got(out, *names) == want(brute.contamination(pairs(docs), items))
    assert decontaminate.drop_contaminated(docs, benchmark).columns == docs.columns


def test_contamination_by_items_without_an_id(spark):
    words = [f"w{k}" for k in range(14)]
    items = spark.createDataFrame([(None, " ".join(words)), (None, "lone"), ("named", "other text")], "item_id string, text string")
    rows = [(1, "x " + " ".join(words[2:13]) + " y"), (2, "a lone word"), (3, "lone other text"), (4, " ".join(words[:9]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = [(1, 11, 0, brute.sha(""), True), (2, 1, 0, brute.sha(""), True), (3, 3, 1, brute.sha("named"), True), (4, 0, 0, brute.sha(""), False)]
    assert got(decontaminate.contamination(docs, items), "doc_id", "n_hit", "n_items", "items_sha256", "contaminated") == want(expected)
    assert {r[0] for r in decontaminate.drop_contaminated(docs, items).select("doc_id").collect()} == {4}


def test_contamination_of_given_tables(spark, small, none):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(str(r[0]), r[1]) for r in benchmark.select("item_id", "text").collect()]
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got(decontaminate.contamination(small, benchmark), *names) == want(brute.contamination(pairs(small), items))
    assert got(decontaminate.contamination(small, none.selectExpr("source AS item_id", "text")), "n_hit") == [(0,)] * small.count()


def test_contamination_by_a_very_long_item(spark, monkeypatch):
    """What is staged grows with the words of an item, not with their square."""
    sizes = {}
    stage = decontaminate.stage

    def measuring(df, label="stage"):
        out = stage(df, label)
        sizes[label] = sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(decontaminate, "stage", measuring)
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**9)}" for _ in range(30_000)]
    rows = [(1, "x " + " ".join(words[12_000:12_400]) + " y"), (2, "nothing of it"), (3, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = spark.createDataFrame([("long", " ".join(words)), ("short", "nothing of")], "item_id string, text string")
    out = got(decontaminate.contamination(docs, items), "doc_id", "n_words", "n_hit", "n_items")
    assert out == [(1, 402, 400, 1), (2, 3, 2, 1), (3, 30_000, 30_000, 1)]
    assert sizes["items"] + sizes["lying"] < 3_000_000


def test_line_fingerprints_are_window_minima(tricky):
    """Only the selected places are kept, and every run of three units has one."""
    lines = F.transform(line_dedup.units(F.col("text")), lambda u: F.xxhash64(F.btrim(u, F.lit(line_dedup._BLANK)))).alias("lines")
    hashed = tricky.select("doc_id", F.xxhash64("text").alias("text_hash"), lines).filter("size(lines) > 0")
    places = {}
    for doc, _, fingerprint, at, served, around in line_dedup.fingerprints(hashed).collect():
        places.setdefault(doc, {})[at] = (fingerprint, served, around)
    kept = every = 0
    for doc, _, own in hashed.collect():
        found = places.get(doc, {})
        begins = sorted(at - k for at, (_, served, _) in found.items() for k in served)
        assert begins == list(range(len(own) - 2))
        for at, (_, _, around) in found.items():
            assert around == [own[at - 1] if at else None, own[at + 2] if at + 2 < len(own) else None]
        kept, every = kept + len(found), every + max(0, len(own) - 2)
    assert kept < 0.8 * every


def test_line_dedup_splits_hot_lines(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = F.when(F.col("id") % 3 == 0, F.lit("a\nb\nc")).otherwise(F.concat_ws("\n", F.md5(F.col("id").cast("string")), F.col("id"), F.lit("z")))
        docs = spark.range(0, 120_000, numPartitions=16).select(F.col("id").alias("doc_id"), text.alias("text"))
        out = line_dedup.repeated_units(docs)
        assert len(out.collect()) == 39_999
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_line_dedup(tricky, none, small):
    for docs in (tricky, none, small):
        expected = brute.line_dedup(pairs(docs))
        out = line_dedup.delete_repeated_lines(docs, ("u", "g", "r"))
        assert out.columns[:-3] == docs.columns
        assert got(out, "doc_id", "text", "u", "g") == want((d, t, n, len(gone)) for d, (n, gone, t) in expected.items())
        assert sorted(line_dedup.drop_repeated_lines(docs).columns) == sorted(docs.columns)


def test_line_dedup_of_repeated_rows(repeated):
    out = line_dedup.delete_repeated_lines(repeated, ("u", "g", "r"))
    assert out.count() == repeated.count()
    by_row = {}
    before = {}
    for (d, t) in pairs(repeated):
        before[(d, t)] = before.get((d, t), 0) + 1
    for r in out.select("doc_id", "text", "g").collect():
        by_row.setdefault(r[0], []).append((r[1], r[2]))
    assert len(set(by_row[0])) == 1 and len(by_row[0]) == 3


def test_passage_dedup(tricky, none, small):
    for docs in (tricky, none, small):
        expected = brute.passage_dedup(pairs(docs))
        out = line_dedup.delete_repeated_lines(docs, ("u", "g", "r"), passage_words=line_dedup.PASSAGE_WORDS)
        assert got(out, "doc_id", "text", "u", "g") == want((d, t, n, len(gone)) for d, (n, gone, t) in expected.items())


def test_passage_dedup_finds_one_and_two_long_lines(spark):
    a, b, short = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("a", 60), ("b", 30), ("c", 25)))
    rows = [(1, f"{a}\nx"), (2, f"y\n{a}"), (3, f"{b}\n{short}"), (4, f"z\n{b}\n\n{short}\nw"), (5, f"{b}\nv"), (6, a)]
    out = line_dedup.delete_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), ("u", "g", "r"), passage_words=50)
    assert dict(pairs(out)) == {1: f"{a}\nx", 2: "y", 3: f"{b}\n{short}", 4: "z\nw", 5: f"{b}\nv", 6: ""}


def test_line_dedup_runs_no_python(tricky):
    plan = line_dedup.delete_repeated_lines(tricky, ("u", "g", "r"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_suffix_merge_sorts_and_reports_common_prefixes():
    rng = random.Random(5)
    for _ in range(300):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 6))]
        merged = list(suffix_dedup.merge_runs([suffix_dedup._read_run(*suffix_dedup._front_code(r)) for r in runs]))
        assert [m[0] for m in merged] == sorted(x for r in runs for x in r)
        for (a, _, _), (b, known, _) in zip(merged, merged[1:]):
            assert known == len(os.path.commonprefix([a, b]))


@pytest.mark.parametrize("hints", [2, 10**9])
def test_suffix_dedup(docs, monkeypatch, hints):
    # All documents give hints, and few or no contexts make an anchor frequent.
    monkeypatch.setattr(suffix_dedup, "HINT_SHARE", 1)
    monkeypatch.setattr(suffix_dedup, "HINT_CONTEXTS", hints)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 16)
    out = suffix_dedup.remove_repeated_strings(docs)
    rows = pairs(docs)
    if len({d for d, _ in rows}) == len(rows):
        assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(brute.repeated_strings(rows))
    else:
        assert out.count() == len(rows)


def test_suffix_dedup_of_repeated_rows(repeated):
    out = suffix_dedup.remove_repeated_strings(repeated)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(brute.repeated_strings(pairs(repeated)))


def test_licenses(docs):
    out = licenses.scan_licenses(docs)
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want((d, *brute.licenses(t)) for d, t in pairs(docs))


def test_licenses_merge_neighbouring_diagonals(spark):
    notice = licenses.NOTICES[12][1].split()
    rows = [(1, "x y " + " ".join(notice)), (2, " ".join(notice[:8] + ["really"] + notice[8:])), (3, " ".join(notice[:6])), (4, "a b c")]
    out = {r[0]: (r[1], r[2]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "labels", "score").collect()}
    assert out[1] == ("mit", 1.0) and out[2][0] == "mit" and 0.75 <= out[2][1] < 1 and out[3] == ("", 0.0) and out[4] == ("", 0.0)


def test_licenses_run_no_python(tricky):
    plan = licenses.scan_licenses(tricky)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_every_labelled_finding_trains_the_secret_network(spark, monkeypatch):
    """Findings beyond one block are dealt over blocks that all take part; the result does not hang on partitions."""
    monkeypatch.setattr(secrets, "BLOCK", 40)
    monkeypatch.setattr(secrets, "ROUNDS", 2)
    rng = random.Random(3)
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    texts = [f"see page {draw('0123456789', 14)} and password = {draw('abcdef123', 9)} of {draw('abcdef', 5)}" for _ in range(90)]
    rows = [(k, t) for k, t in enumerate(texts)]
    found, blocks = [], secrets.finding_blocks

    def noting(each, count):
        out = blocks(each, count)
        found.append((count, each.distinct().count(), sum(r.n for r in out.select("n").collect())))
        return out

    monkeypatch.setattr(secrets, "finding_blocks", noting)
    results = [
        sorted(tuple(r) for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(n)).collect())
        for n in (1, 5)
    ]
    assert all(count == 5 and all_of == 180 == dealt for count, all_of, dealt in found) and len(found) == 2
    assert [r[:6] for r in results[0]] == [r[:6] for r in results[1]]
