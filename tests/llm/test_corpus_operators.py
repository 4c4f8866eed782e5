"""The corpus operators against brute force on small fixtures, with the edge cases of each."""

import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("tessera.llm.queries")

from tessera.llm import decontaminate, licenses, pii  # noqa: E402
from tessera.llm import order_minhash as omh  # noqa: E402
from tessera.llm.line_dedup import dedup_lines  # noqa: E402
from tessera.llm.near_duplicates import near_duplicates  # noqa: E402
from tessera.llm.packing import pack_documents, plan_fillings  # noqa: E402
from tessera.llm.queries import QUERIES, public_vocabulary  # noqa: E402
from tessera.llm.sharding import interleaved_shards  # noqa: E402
from tessera.llm.token_counts import LongestMatch, token_counts  # noqa: E402
from tessera.llm.toxicity import Characters, toxicity, without_toxic  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component long, rep int"
LONG = " ".join(f"word{i}" for i in range(9000))
WORDS = "red blue green cat dog tree house river stone cloud bird fish moon star wind".split()


def rows():
    rng = random.Random(5)
    out = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "ONE two"),
           (7, LONG), (8, LONG), (8, LONG), (None, "a null id with some words in it"),
           (9, "mail a@b.co now\nReleased under the MIT License."), (10, "tie"), (10, "tied")]
    for i in range(20, 60):
        text = [rng.choice(WORDS) for _ in range(40)]
        out.append((i, " ".join(text)))
        text[rng.randrange(40)] = "changed"
        out.append((100 + i, " ".join(text)))
    return [(i, t, "en", None if (i or 0) % 3 == 0 else f"s{(i or 0) % 2}", 0, 5, 1) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(20, 160)],
                                 "doc_id long, quality int, toxic int")


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


# --- near-duplicates ---------------------------------------------------------------
def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(docs, k, percent):
    data = [(r[0], shingles(r[1], k)) for r in rows()]
    parent = {i: i for i, _ in data}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, one in data:
        for b, two in data:
            both = len(one & two)
            if None not in (a, b) and both and 100 * both >= percent * len(one | two):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(docs, k, percent).collect()}
    assert got == {(i, len(s), None if i is None else root(i), i is None or root(i) == i)
                   for i, s in data}


def test_near_duplicate_family_around_a_centre(spark):
    rng, base = random.Random(1), [f"w{i}" for i in range(120)]
    data = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(0, 12)):
            text[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        data.append((i, " ".join(text)))
    sets = [shingles(t, 3) for _, t in data]
    parent = list(range(150))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(150):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    got = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: root(i) for i in range(150)}


# --- line dedup --------------------------------------------------------------------
def test_line_dedup_within_one_word(spark):
    line = "the quick brown fox jumps over the lazy dog"
    data = [(1, f"{line}\nkeep me\n\n"), (2, f"{line.upper()}\nkeep  me too"),
            (3, line.replace("quick", "slow") + "\nown line"), (4, line + " again"),
            (5, line.replace("quick", "slow").replace("lazy", "old")), (6, None), (7, ""),
            (8, "one two three"), (9, "one two four"), (9, "one two four")]
    out = dedup_lines(spark.createDataFrame(data, "doc_id long, text string"),
                      counts=("n", "dropped")).collect()
    got = {(r.doc_id, r.text) for r in out}
    assert len(out) == len(data)
    # 5 is one word from 3, which is earlier, though 3 itself goes
    assert got == {(1, f"{line}\nkeep me\n\n"), (2, "keep  me too"), (3, "own line"), (4, ""),
                   (5, ""), (6, None), (7, ""), (8, "one two three"), (9, "one two four")}


def test_long_lines_may_differ_by_a_tenth_of_their_words(spark):
    rng, data = random.Random(8), []
    for n in (18, 20, 21, 39, 40, 41, 57, 90, 150):
        for k in range(3):
            base = [f"b{rng.randrange(10**6)}" for _ in range(n)]
            data.append(base)
            for e in {1, 2, n // 10 - 1, n // 10, n // 10 + 1}:
                line = list(base)
                for j, place in enumerate(sorted(rng.sample(range(n), max(e, 1)), reverse=True)):
                    line[place:place + 1] = [[f"x{rng.randrange(10**6)}"], [], [line[place], f"y{n}"]][(j + k) % 3]
                data.append(line)
    base = [f"w{i}" for i in range(60)]
    for i in range(40):  # a crowd with common marks, many of them far from its earliest line
        data.append([f"c{rng.randrange(10**6)}" if rng.random() < 0.08 else w for w in base])
    bound = lambda a, b: max(1, max(len(a), len(b)) // 10)
    want = {i for i, a in enumerate(data)
            if any(abs(len(a) - len(b)) <= 15 and edit_distance(a, b) <= bound(a, b) for b in data[:i])}
    out = dedup_lines(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(data)],
                                            "doc_id long, text string"))
    assert {r.doc_id for r in out.collect() if r.text == ""} == want
    assert any(edit_distance(data[i], data[j]) > 1 for i in want for j in range(i))


def test_line_dedup_passes_other_columns_on(docs, empty):
    assert dedup_lines(docs).columns == docs.columns
    assert dedup_lines(empty).collect() == []


# --- decontamination ---------------------------------------------------------------
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def test_myers_equals_the_plain_recursion():
    rng = random.Random(3)
    for _ in range(200):
        p = [rng.choice("abc") for _ in range(rng.randint(1, 70))]
        w = [rng.choice("abc") for _ in range(rng.randint(0, 20))]
        want = [min(edit_distance(p, w[s:e]) for s in range(e + 1)) for e in range(1, len(w) + 1)]
        assert decontaminate.myers(p, w) == want


def test_edited_items_are_found(spark, docs, empty):
    item = "what is the name of the river that runs through the old stone town"
    near = item.replace("river", "stream").replace("old ", "")
    far = item.replace("river", "x").replace("old", "y").replace("name", "z").replace("town", "v")
    data = [(1, f"before {item.upper()}, after"), (2, f"a\n{near}%%%"), (3, far), (4, None), (5, "")]
    some = spark.createDataFrame(data, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    hits = decontaminate.benchmark_hits(some, bench)
    assert {(r.doc_id, r.item_id, r.distance) for r in hits.collect()} == {(1, 7, 0), (2, 7, 2)}
    assert {r.doc_id for r in decontaminate.without_contaminated(some, hits).collect()} == {3, 4, 5}
    assert decontaminate.benchmark_hits(empty, bench).collect() == []
    assert decontaminate.benchmark_hits(docs, bench.limit(0)).collect() == []


# --- packing, token counts -----------------------------------------------------------
def test_pieces_are_the_tokenizers_ids_and_fit(docs, empty):
    from tokenizers import Tokenizer
    path = public_vocabulary("word_bpe_49k.json")
    tok = Tokenizer.from_file(path())
    want = []
    for r in rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [1]
        for k, lo in enumerate(range(0, len(ids), 512)):
            part = ids[lo:lo + 512]
            raw = b"".join(i.to_bytes(4, "little") for i in part)
            want.append((r[0], k, lo, len(part), zlib.crc32(raw)))
    got = pack_documents(docs, path, capacity=512).collect()
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    used = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 512
    assert len(used) <= -(-sum(used.values()) // 512) + 1
    assert pack_documents(empty, path).collect() == []


def test_fillings_use_every_piece_once():
    rng = random.Random(2)
    for _ in range(30):
        histogram = {rng.randint(1, 60): rng.randint(1, 50) for _ in range(rng.randint(1, 25))}
        plan = plan_fillings(histogram, 60)
        used = {}
        for filling, copies in plan:
            assert sum(filling) <= 60
            for size in filling:
                used[size] = used.get(size, 0) + copies
        assert used == histogram
    assert sum(n for _, n in plan_fillings({6: 1000, 4: 1000, 5: 2}, 10)) == 1001
    assert plan_fillings({}) == []


def test_longest_match_counts(docs):
    rng = random.Random(4)
    for _ in range(500):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
                  for _ in range(rng.randint(1, 9))}
        automaton = LongestMatch(pieces)
        word = "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 14)))
        n = i = 0
        while i < len(word):
            size = max((k for k in range(1, 6) if word[i:i + k] in pieces), default=0)
            n, i = n + (1 if size else len(word[i].encode())), i + max(size, 1)
        assert automaton.count(word) == n
    out = {r.doc_id: r for r in token_counts(docs, lambda: ["▁", "▁one", "t", "w", "o"]).collect()}
    assert (out[1].n_tokens, out[2].n_tokens, out[4].n_tokens, out[5].n_tokens) == (0, 0, 1, 5)


# --- shards, fingerprints ------------------------------------------------------------
def test_shards_hold_the_mixture(spark, docs, empty):
    out = interleaved_shards(docs, 4).collect()
    sizes = [sum(r.shard == s for r in out) for s in range(4)]
    assert len(out) == len(rows()) and max(sizes) - min(sizes) <= 1
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert {(r.doc_id, r.size, r.text_crc32) for r in out} == {
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows()}
    mixed = spark.createDataFrame([(i, "x", "a" if i < 300 else f"b{i % 5}") for i in range(800)],
                                  "doc_id long, text string, source string")
    of = {i: "a" if i < 300 else f"b{i % 5}" for i in range(800)}
    got = interleaved_shards(mixed).collect()
    for source, n in (("a", 300), ("b1", 100)):
        per = [sum(r.shard == s and of[r.doc_id] == source for r in got) for s in range(8)]
        assert all(abs(x - n / 8) <= 2 for x in per)
    assert interleaved_shards(empty).collect() == []


def test_fingerprints_follow_the_next_document(docs, empty):
    order = sorted(((-1 if r[0] is None else r[0]), r[1] or "") for r in rows())
    once = [x for x in order if sum(y[0] == x[0] for y in order) == 1]
    out = {r.doc_id: r for r in omh.fingerprints(docs).collect()}
    make = omh.OrderMinHash()
    for i, (doc, text) in enumerate(order):
        after = order[(i + 1) % len(order)]
        if (doc, text) in once and after in once:
            changed = omh.edited(text, after[1])
            r = out[None if doc == -1 else doc]
            assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            assert r.fingerprint == omh.text_of(make.signature(text))
            assert r.edited_fingerprint == omh.text_of(make.signature(changed))
    assert out[7].fingerprint == out[8].fingerprint and out[1].fingerprint == ""
    assert omh.fingerprints(empty).collect() == []


# --- licences, personal data, toxicity -------------------------------------------------
def test_license_places_and_covered_templates(spark, docs, empty):
    mit = licenses.TEMPLATES["mit"][0].upper().replace("CHARGE", "charge,\n")
    data = [(1, "Under the MIT license, under the mit license. CC BY-NC 4.0"), (2, mit), (3, None),
            (4, "the license of the software"), (5, "GNU General Public License, version 3."),
            (6, "apache license version 2")]
    out = {r.doc_id: r for r in licenses.license_scan(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert (out[1].n_base, out[1].first_word, out[1].last_word) == (3, 0, 8)
    assert out[1].base_labels == out[1].labels == "cc-by-nc,mit"
    assert (out[2].base_labels, out[2].labels) == ("", "mit") and out[2].score == 1.0
    assert (out[3].n_words, out[3].first_word, out[3].score) == (0, None, 0.0)
    assert out[4].labels == "" and out[5].labels == "gpl-3"
    assert out[6].base_labels == "apache-2"
    assert licenses.license_scan(docs).count() == len(rows())
    assert licenses.license_scan(empty).collect() == []


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(6)
    for _ in range(5000):
        text = "".join(rng.choice("a@.-1 2+(%") for _ in range(rng.randint(0, 24)))
        want = []
        for kind, pattern in PLAIN.items():
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m.group())
                if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                        or kind == "card" and 12 <= len(digits) <= 19 and pii.luhn(digits)
                        or kind == "phone" and 9 <= len(digits) <= 15):
                    want.append((m.start(), kind, m.end()))
        assert pii.joined(pii.base_spans(text)) == pii.joined(want)


def test_the_field_adds_what_patterns_miss(docs, empty):
    model = pii.ChainField().train(pii.labelled_rows())
    texts = ["reach me at 646-555-0123 ok", "in 2019 there were 1300 cases", ""]
    found = pii.added_spans(texts, model)
    assert [(k, texts[0][a:b]) for a, k, b in found[0]] == [("phone", "646-555-0123")]
    assert found[1:] == [[], []]
    assert pii.personal_data(docs).count() == len(rows())
    assert pii.personal_data(empty).collect() == []


def test_spelled_out_addresses_in_any_case_as_by_decoding_whole_texts(monkeypatch):
    model = pii.ChainField().train(pii.labelled_rows())
    forms = ["JANE AT EXAMPLE DOT COM", "Jane (AT) Example (DOT) Com", "jane at example.com",
             "jane (dot) doe at example (dot) com", "jane@example.com", "jane [At] example [Dot] com"]
    fill = "the river ran by old stone houses and many people walked along it every day " * 3
    texts = [f"{fill}mail me: {x} please {fill}" for x in forms]
    rows = [t for t, _ in pii.labelled_rows()]
    texts += [f"{a} {fill}\n{b}" for a, b in zip(rows, rows[1:], strict=False)]
    found = pii.added_spans(texts, model)
    for form, text, spans in zip(forms, texts, found, strict=False):
        assert any(k == "email" and text[a:b] in form and pii.AT.search(text[a:b])
                   for a, k, b in spans), form
    monkeypatch.setattr(pii, "windows", lambda text: [(0, len(text))])
    assert found == pii.added_spans(texts, model)


def test_spans_in_long_windows_are_whole():
    model = pii.ChainField().train(pii.labelled_rows())
    for shift in range(12):
        text = "at 5 or 6 places " * 78 + "and 7 " * shift + "phone 0044 20 7946 0958 for orders " \
            + "in 2019 there were 1200 cases " * 100
        assert len(pii.windows(text)) == 1
        found = [(k, text[a:b]) for a, k, b in pii.added_spans([text], model)[0]]
        assert ("phone", "0044 20 7946 0958") in found and not any(
            x in "0044 20 7946 0958" and x != "0044 20 7946 0958" for _, x in found)


def test_obfuscated_words_are_restored():
    counts = {}
    for word in ["idiot", "stupid", "trash", "loser", "hello", "house"] * 50:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            code = (a * len_alphabet() + b) * len_alphabet() + c
            counts[code] = counts.get(code, 0) + 1
    model = Characters(counts)
    assert [model.restore(w) for w in ("1d10t", "$tup1d", "tra5h", "looooser", "hello")] == [
        "idiot", "stupid", "trash", "loser", "hello"]
    assert "idiot" in model.words("what an i d i o t he is")


def len_alphabet():
    from tessera.llm.toxicity import SIZE
    return SIZE


def test_toxicity_learns_from_labels_and_reads_any_row(spark, docs, empty, labels):
    rng, data = random.Random(9), []
    for i in range(400):
        words = [rng.choice(WORDS) for _ in range(60)]
        if i % 4 == 0:
            words[7] = words[30] = "vilething"
        data.append((i, " ".join(words)))
    known = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(0, 300)],
                                  "doc_id long, quality int, toxic int")
    own = spark.createDataFrame(data, "doc_id long, text string")
    out = toxicity(own, known).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert {r.doc_id for r in without_toxic(own, known).collect()} == {
        i for i in range(400) if i % 4}
    assert toxicity(docs, labels).count() == len(rows())
    assert toxicity(docs, labels.limit(0)).filter("score <> 0").count() == 0
    assert toxicity(empty, labels).collect() == []


def test_pipeline_stages(spark, docs, empty, labels, tmp_path):
    import corpus_pipeline
    path = str(tmp_path)
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, LONG[:300])], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    for start in (docs, empty):
        frame = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before, frame = frame, stage(spark, frame, path)
            assert frame.columns == before.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, frame, path).collect()
        if start is docs:
            left = [r.doc_id for r in packed]
            assert 7 not in left and 8 not in left  # they hold the benchmark item
            assert {1, 2, 4, 5, None} <= set(left) and 6 not in left
        else:
            assert packed == []


def test_fingerprints_do_not_depend_on_the_number_of_ranges(spark, docs):
    n = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for ranges in ("1", "3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            seen.append(sorted(map(str, omh.fingerprints(docs).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0]) == docs.count()


def test_phrases_of_one_word_count(spark):
    df = spark.createDataFrame([(1, "MIT or not"), (2, "a mit b, mit")], "doc_id long, text string")
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word, r.labels)
           for r in licenses.license_scan(df, {"mit": "x"}, {}).collect()}
    assert got == {1: (1, 0, 0, "x"), 2: (2, 1, 3, "x")}
