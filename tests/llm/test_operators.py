"""The training-data operators on small tables, against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, text_key string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "y") for i, t in rows], DOCS)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    long = ". ".join(words(rng, 12) for _ in range(700))
    base = words(rng, 90)
    near = base.split()
    near[40] = "changed"
    return [(1, None), (2, ""), (3, "  \n \n"), (4, long), (5, base), (6, base), (7, " ".join(near)), (7, " ".join(near)),
            (8, "a shared line here\nown line of eight"), (9, "A Shared Line Here \nown line of nine"),
            (None, "no id but a shared line here\na shared line here"), (10, "two  spaces\t and end "), (11, "word")]


def fresh_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_library():
    import pyarrow as pa
    from vitrine.llm.tokens import WordEncoder, vocabulary_path

    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u3000", "\x0b", "\x1c", "\x85", "a", "Word", "é", "×", "ß", "1", "'s", "'ll",
             ".", "...", "!?", "_", "«", "<|endoftext|>", "日本", "😀", "e\u0301", "\x00", "a.b,c", "-- "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 14))) for _ in range(4000)] + ["", " ", "a <|endoftext|> b", "x" * 5000]
    encoder, plain = WordEncoder(vocabulary_path()), fresh_tokenizer()
    for at in range(0, len(texts), 700):  # rounds, some with all words known, some after words were forgotten
        some = texts[at:at + 700]
        ids, edges = encoder.encode(pa.array(some, pa.string()), 9)
        got = [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
        assert got == [[*e.ids, 9] for e in plain.encode_batch(some, add_special_tokens=False)]
        encoder.shrink(len(encoder.known) // 3)


def test_pieces_cover_every_id_once(spark, odd_rows):
    from vitrine.llm.packing import pack_documents

    odd_rows = [*odd_rows, (12, "a <|endoftext|> b")]
    got = pack_documents(frame(spark, odd_rows)).collect()
    rows, covered = {}, {}
    for doc_id, text in odd_rows:
        ids = fresh_tokenizer().encode(text or "", add_special_tokens=False).ids
        rows.setdefault(doc_id, []).append(np.array([*ids, 1], dtype="<u4"))
    at = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert at.get(r["sequence_id"], 0) == r["offset"]
        at[r["sequence_id"]] = r["offset"] + r["length"]
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["length"]
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes())
                   == r["ids_crc32"] for x in rows[r["doc_id"]])
    assert max(at.values()) <= 2048
    assert covered == {k: sum(map(len, v)) for k, v in rows.items()}


def test_cuts_are_the_cheapest():
    from vitrine.llm.packing import cut_places

    rng = random.Random(1)
    for _ in range(50):
        places = sorted(rng.sample(range(1, 60), 25)) + [60]
        costs = [rng.choice((0, 3, 9)) for _ in places[:-1]] + [0]
        best = {0: 0}
        for p, c in zip(places, costs):
            best[p] = min((best[q] + 16 - (p - q) + c for q in best if 0 < p - q <= 16), default=math.inf)
        if math.isinf(best[60]) or any(math.isinf(v) for v in best.values()):
            continue
        cuts, price = cut_places(places, costs, 16), dict(zip(places, costs))
        assert sum(16 - (b - a) + price[b] for a, b in zip([0, *cuts], cuts)) == best[60]


def test_token_files_round_trip(spark, odd_rows, folder):
    from vitrine.llm.tokens import read_metadata, read_tokens, token_digests, write_tokens

    path = f"{folder}/tokens"
    odd_rows = [*odd_rows, (12, "a <|endoftext|> b")]
    write_tokens(frame(spark, odd_rows), path)
    tokenizer = fresh_tokenizer()
    held = {}
    for r in read_tokens(spark, path).collect():
        held.setdefault(r["doc_id"], []).append(r["ids"])
    for doc_id, text in odd_rows:
        assert [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0] in held[doc_id]
    digests = token_digests(spark, path).orderBy("start").collect()
    total = 0
    for r in digests:
        assert r["start"] == total
        total += r["n_tokens"]
    assert sorted(map(tuple, read_metadata(spark, path).collect()), key=str) == sorted(
        [(r["doc_id"], r["start"], r["n_tokens"]) for r in digests], key=str)
    assert {r["doc_id"] for r in read_tokens(spark, path, 4, 6).collect()} == {4, 5, 6}


def test_lines_against_brute_force(spark, odd_rows):
    from vitrine.llm.line_dedup import dedup_lines

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\t\n\x0b\x0c\r "))

    last = 1 << 62
    holders = {}
    for d, text in odd_rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(last if d is None else d)
    want = []
    for d, text in odd_rows:
        lines = (text or "").split("\n")
        own = last if d is None else d
        kept = [x for x in lines if not (len(holders.get(key(x), ())) > 1 and own > min(holders[key(x)]))]
        want.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = dedup_lines(frame(spark, odd_rows), batches=3).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_near_duplicates(spark, odd_rows):
    from vitrine.llm.order_minhash import near_duplicate_groups, one_of_each

    groups = {r["doc_id"]: r["group_id"] for r in near_duplicate_groups(frame(spark, odd_rows)).collect()}
    assert groups[5] == groups[6] == groups[7] == 5
    assert groups[1] == groups[2] == 1 and groups[3] == 3 and groups[4] == 4
    kept = [r["doc_id"] for r in one_of_each(frame(spark, odd_rows)).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 8, 9, None, 10, 11], key=str)


def test_large_near_groups_against_brute_force(spark):
    from vitrine.llm.order_minhash import SIMILARITY, aligned_similarity, labelled_kmers, near_duplicate_groups

    rng = random.Random(11)
    texts = []
    for size in (150, 700):  # some without the text they all come from
        base = words(rng, size).split()
        for k in range(70):
            own = list(base)
            for place in rng.sample(range(size), rng.randint(0 if size == 150 else 1, size // 12)):
                own[place] = words(rng, 1)
            texts.append(" ".join(own))
        texts.append(" ".join(base[size // 2:] + base[:size // 2]))
    kmers = [labelled_kmers([t])[0] for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if aligned_similarity(kmers[i], kmers[j]) >= SIMILARITY:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    got = near_duplicate_groups(frame(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["group_id"] for r in got} == dict(enumerate(group))
    assert 10 < len(set(group)) < 130


def test_bounds_of_near_duplicates():
    from vitrine.llm.order_minhash import labelled_kmers, parity_bits

    rng = random.Random(12)
    base = words(rng, 300).split()
    texts = ["", "one"]
    for k in range(30):
        texts.append(" ".join(w if rng.random() > k / 100 else "other" for w in base))
    labelled, counts = labelled_kmers(texts)
    sets = [set(x.tolist()) for x in np.split(labelled, np.cumsum(counts)[:-1])]
    bits = parity_bits(labelled, counts).view(np.uint64)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            assert sum(int(v).bit_count() for v in bits[a] ^ bits[b]) <= len(x ^ y)


def test_contained_items(spark):
    from vitrine.llm.contamination import clean_documents, contained_items

    rng = random.Random(9)
    items = [words(rng, n) for n in (5, 14, 40, 90)]
    docs = [(i, f"{words(rng, 300)} {item.upper()}, {words(rng, 300)}") for i, item in enumerate(items)]
    docs += [(10, words(rng, 400)), (11, None), (12, ""), (13, " ".join(items[3].split()[:50]))]
    table = spark.createDataFrame([(i, t) for i, t in enumerate([*items, None, "four words are few"])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contained_items(frame(spark, docs), table).collect()}
    assert got == {(i, i) for i in range(4)}
    assert {r["doc_id"] for r in clean_documents(frame(spark, docs), table).collect()} == {10, 11, 12, 13}


def test_contained_items_with_null_and_repeated_ids(spark):
    from vitrine.llm.contamination import clean_documents, contained_items

    rng = random.Random(10)
    items = [(None, words(rng, 20)), (1, words(rng, 30)), (1, words(rng, 60))]
    docs = [(None, f"{words(rng, 50)} {items[1][1]}"), (None, words(rng, 80)), (5, f"{items[0][1]} {words(rng, 50)}"),
            (6, items[2][1]), (7, words(rng, 90))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contained_items(frame(spark, docs), table).select("doc_id", "item_id", "item_shingles", "containment").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 26, 1.0), (5, None, 16, 1.0), (6, 1, 56, 1.0)], key=str)
    kept = clean_documents(frame(spark, docs), table).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([docs[1], docs[4]], key=str)


def test_shards_are_even_and_groups_whole(spark):
    from vitrine.llm.sharding import shard_documents

    rows = [(i, f"text {i // 3 if i < 60 else i}") for i in range(203)] + [(300 + i, "hot") for i in range(90)] + [(1, None), (None, None)]
    got = shard_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in shards.values()]
    assert len(shards) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    whole = {}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 60 and r["size"] > 1:
            whole.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in whole.values()) <= len(whole) // 4


@pytest.mark.parametrize("copies", (2, 4))
def test_shards_keep_groups_whole_where_every_text_has_copies(spark, copies):
    from vitrine.llm.sharding import shard_documents

    got = shard_documents(frame(spark, [(i, f"text {i // copies}") for i in range(6400)])).collect()
    sizes, whole = {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
        whole.setdefault(r["doc_id"] // copies, set()).add(r["shard"])
    assert sorted(sizes.values()) == [400] * 16
    assert sum(len(s) > 1 for s in whole.values()) <= 16


def test_vectors_against_brute_force(spark):
    from vitrine.llm.lattice_hash import LatticeTables, near_vectors

    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 24))
    x[100:150] = x[:50] + 0.12 * rng.standard_normal((50, 24))
    x[150:160] = x[0]
    rows = [(i, v.tolist(), int(i % 100 % 3)) for i, v in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, x[0].tolist(), None), (904, [1.0], 1)]
    got = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows[:300]])
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels) & ~np.eye(300, dtype=bool)
    assert [got[i]["n_links"] for i in range(300)] == near.sum(axis=1).tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(900, 905))
    # recall at the threshold itself
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    p = rng.standard_normal((3000, 64))
    p -= (p * a).sum(axis=1, keepdims=True) * a
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    tables = LatticeTables(64)
    ca, cb = tables.cells(a), tables.cells(0.98 * a + math.sqrt(1 - 0.98 ** 2) * p)
    met = ((ca[:, :, :1] == cb) | (cb[:, :, :1] == ca)).any(axis=(1, 2))
    assert met.mean() > 0.999


def test_language_sums_over_all_segmentations():
    from vitrine.llm.language import PieceModel

    model = PieceModel(["a", "b", "ab", "ba"], ["x"])
    model.table = np.array([[0.01], [0.3], [0.2], [0.25], [0.24]])
    # a|b|a, ab|a, a|ba
    want = 0.3 * 0.2 * 0.3 + 0.25 * 0.3 + 0.3 * 0.24
    assert math.isclose(model.log_scores(["aba"])[0, 0], math.log(want))


def all_cuts(word):
    """Every way to cut a word into pieces."""
    return [[word]] + [[word[:i], *rest] for i in range(1, len(word)) for rest in all_cuts(word[i:])]


def test_language_pieces_learnt_over_all_segmentations():
    from vitrine.llm.language import UNSEEN, PieceModel

    pieces = ["a", "b", "c", "ab", "bca", "abcab"]
    counts = [Counter({"abcab": 3, "cab": 2, "bxa": 1}), Counter({"ca": 4, "abcab": 1})]
    model = PieceModel(pieces, ["x", "y"])
    for _ in range(3):
        table, want = model.table.copy(), np.full_like(model.table, UNSEEN)
        for g, words_of in enumerate(counts):
            for word, n in words_of.items():
                ids = [[pieces.index(p) + 1 if p in pieces else 0 for p in cut] for cut in all_cuts(word)
                       if all(p in pieces or len(p) == 1 for p in cut)]
                chances = [math.prod(table[i, g] for i in cut) for cut in ids]
                for cut, chance in zip(ids, chances):
                    for i in cut:
                        want[i, g] += n * chance / sum(chances)
        model.fit(counts, rounds=1)
        assert np.allclose(model.table, want / want.sum(axis=0))


def test_language_long_words_are_summed_whole(monkeypatch):
    from vitrine.llm import language

    rng = random.Random(4)
    model = language.PieceModel(["a", "b", "ab", "ba", "abba", "aabbab"], ["x", "y"])
    model.table = np.array([[0.01, 0.02], [0.3, 0.2], [0.2, 0.3], [0.2, 0.1], [0.1, 0.2], [0.1, 0.1], [0.09, 0.08]])
    some = ["".join(rng.choices("abz", k=n)) for n in (1, 49, 50, 51, 400, 1003)]
    whole = model.log_scores(some)
    monkeypatch.setattr(language, "_STRETCH", 50)
    assert np.allclose(model.log_scores(some), whole) and np.isfinite(whole).all()
    short = "abzabbab"
    want = sum(math.prod(model.table[model.pieces.index(p) + 1 if p in model.pieces else 0, 0] for p in cut)
               for cut in all_cuts(short) if all(p in model.pieces or len(p) == 1 for p in cut))
    assert math.isclose(model.log_scores([short])[0, 0], math.log(want))


def test_language_vocabulary_is_kept_whole():
    from vitrine.llm.language import VOCABULARY, public_pieces
    from vitrine.llm.tokens import vocabulary_path

    pieces = public_pieces(vocabulary_path(VOCABULARY))
    assert max(map(len, pieces)) > 12 and all(p.isalpha() and p == p.lower() for p in pieces)


def test_language_held_out(spark):
    from vitrine.llm.language import identify_languages

    rng = random.Random(2)
    parts = {"aa": ["ing", "the", "sh", "ow"], "bb": ["eau", "ieu", "que", "ou"]}
    rows = [(i, " ".join("".join(rng.choices(parts[k], k=3)) for _ in range(20)), k) for i, k in enumerate(["aa", "bb"] * 60)]
    rows += [(500, None, "aa"), (501, "123 !", "bb")]
    got = {r["doc_id"]: r for r in identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows[:120])
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und"


def test_toxicity_held_out(spark):
    from vitrine.llm.toxicity import score_toxicity

    rng = random.Random(6)
    rows = [(i, words(rng, 30) + (" you stupid idiot " if i % 4 == 0 else " ") + words(rng, 30)) for i in range(240)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score_toxicity(frame(spark, rows), labels).collect()}
    assert len(got) == 242 and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(240))


def features(text, lexicon):
    import pyarrow as pa
    from vitrine.llm.toxicity import FEATURES, Reader

    return dict(zip(FEATURES, Reader(lexicon).features(pa.array([text]))[0].tolist()))


def test_disguised_insults_count_as_hits():
    from vitrine.llm.toxicity import INSULTS

    lexicon = frozenset(INSULTS)
    plain = features("well you idiot of mine", lexicon)
    for word in ("1diot", "id1ot", "$tupid", "@sshole", "stuuuupid", "asssshole", "i.d.i.o.t", "1d10t!", "c10wn", "i d i o t",
                 "i d 1 o t", "i d i o t,"):
        got = features(f"well you {word} of mine", lexicon)
        assert got["disguised_hits"] == got["near_second_person"] == 1, word
        assert got["hits"] > 0 and got["hit_rate"] > 0
    for name in ("hits", "near_second_person"):
        assert plain[name] == features("well you 1diot of mine", lexicon)[name]
    for text in ("you see 10 dogs, e.g. soooo big", "a b c d", "WOW you"):
        got = features(text, lexicon)
        assert got["hits"] == got["disguised_hits"] == 0
    assert got["second_person_rate"] == got["shouted_rate"] == 0.5


def features_by_hand(text, lexicon):
    """The features that count plain words, token by token."""
    import re
    from vitrine.llm.toxicity import NEAR, SECOND_PERSON, SMOOTHING

    tokens = [re.findall(r"[^\W\d_]+", t.lower()) for t in text.split()]
    words = [w for t in tokens for w in t]
    hits = [i for i, t in enumerate(tokens) if any(w in lexicon for w in t)]
    people = [i for i, t in enumerate(tokens) if any(w in SECOND_PERSON for w in t)]
    count = sum(w in lexicon for w in words)
    size = max(1, len(text.encode()))
    return {"hits": count / (max(1, len(words)) + SMOOTHING), "hit_rate": count / max(1, len(words)),
            "near_second_person": sum(any(abs(i - j) <= NEAR for j in people) for i in hits),
            "second_person_rate": sum(w in SECOND_PERSON for w in words) / max(1, len(words)),
            "capital_rate": sum("A" <= c <= "Z" for c in text) / size,
            "exclamation_rate": text.count("!") / size, "question_rate": text.count("?") / size,
            "digit_rate": sum("0" <= c <= "9" for c in text) / size}


def test_features_of_many_texts_are_those_of_each():
    import pyarrow as pa
    from vitrine.llm.toxicity import FEATURES, INSULTS, Reader

    rng = random.Random(12)
    some = ["you", "idiot", "moron,", "YOU!", "tu", "word", "word?", "l'idiota", "idiot-moron", "7", "--", "Été", "日本語", "a1b2"]
    texts = [" ".join(rng.choices(some, k=rng.randrange(0, 40))) for _ in range(200)] + ["", " ", "you", "idiot"]
    lexicon = frozenset(INSULTS)
    rows = Reader(lexicon).features(pa.array(texts))
    for text, row in zip(texts, rows.tolist()):
        got = dict(zip(FEATURES, row))
        for name, value in features_by_hand(text, lexicon).items():
            assert got[name] == pytest.approx(value), (name, text)
        assert row == pytest.approx(Reader(lexicon).features(pa.array([text]))[0].tolist())


@pytest.mark.parametrize("unit", ["i d i o t, ", "you idiot ", "i d i o t ", "1d10t ", "x", "you a1 "])
def test_features_take_time_in_proportion_to_the_text(unit):
    import time
    import pyarrow as pa
    from vitrine.llm.toxicity import INSULTS, Reader

    reader, text = Reader(frozenset(INSULTS)), unit * (500_000 // len(unit))
    began = time.process_time()
    reader.features(pa.array([text]))
    assert time.process_time() - began < 5


def test_toxic_words_of_a_small_second_language(spark):
    from vitrine.llm.toxicity import score_toxicity

    rng = random.Random(16)
    rows, toxic = [], set()
    for i in range(1200):
        bad = i % 10 == 0
        if i % 6 == 0:  # the small language: none of its insults is a fixed one
            word = rng.choice(("zorgul", "vrakten", "ploomar")) if bad else "gentle"
            rows.append((i, " ".join("".join(rng.choices("klmnopq", k=5)) for _ in range(30)) + f" {word}."))
        else:
            rows.append((i, words(rng, 30) + (" you idiot." if bad else " you all.")))
        if bad:
            toxic.add(i)
    labels = spark.createDataFrame([(i, int(i in toxic)) for i, _ in rows], "doc_id long, toxic int")
    got = score_toxicity(frame(spark, rows), labels).where("held_out").collect()
    assert all((r["predicted"] == 1) == (r["doc_id"] in toxic) for r in got)
    assert any(r["doc_id"] in toxic and r["doc_id"] % 6 == 0 for r in got)


def test_toxicity_of_disguises_absent_from_training(spark):
    from vitrine.llm.toxicity import score_toxicity

    rng = random.Random(6)
    rows = [(i, words(rng, 30) + (" you stupid idiot " if i % 4 == 0 else " ") + words(rng, 30)) for i in range(240)]
    rows += [(900 + k, f"{words(rng, 30)} you {a} {b} {words(rng, 30)}")
             for k, (a, b) in enumerate((("$tupid", "1diot"), ("stuuuupid", "i.d.i.o.t"), ("5tup1d", "i d i o t")))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(240)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in score_toxicity(frame(spark, rows), labels).collect()}
    assert [got[k] for k in (900, 901, 902)] == [1, 1, 1]


def test_main_text():
    from vitrine.llm import main_text as m

    model = m.train()
    right = total = 0
    for seed in range(700_000_000, 700_000_060):
        blocks, labels = m.labelled_page(seed)
        right += sum(bool(a) == b for a, b in zip(labels, model.decode(blocks)))
        total += len(labels)
    assert right / total > 0.97
    page = ("<body><nav><ul><li><a href=x>Home</a></ul></nav><div class=ad>Buy this now, it is cheap.</div><article><h1>A &amp; B</h1>"
            "<p>First   paragraph,\n with words.<p>Second one.</article><div class=comments><p>Nice article, thank you all.</div>"
            "<footer>&copy; me</footer>")
    assert m.main_text(page, model) == "A & B\n\nFirst paragraph, with words.\n\nSecond one."
    assert m.main_text(None, model) == m.main_text("", model) == ""


@pytest.mark.parametrize("odd", ["<svg width=1 />", "<select><option>", "<object>", "<math/>", '<img alt="x>', "<svg><path d=1></svg>"])
def test_an_article_is_not_lost_behind_odd_markup(odd):
    from vitrine.llm.page_blocks import read_blocks

    page = (f"<body><article><h1>Title here</h1>{odd}<p title='a > b'>First paragraph of the article.</p>"
            "<p title='c > d'>Second paragraph of it.</p></article></body>")
    texts = [b.text for b in read_blocks(page, lambda state, tag, names: None)]
    assert texts[0] == "Title here" and texts[-1] == "Second paragraph of it."
    assert "First paragraph of the article." in texts and not any("b'" in t or "d'" in t for t in texts)


@pytest.mark.parametrize("page", [
    "<div>" * 16_000 + "<li>x</li>" * 16_000, "<li>x" * 30_000, "<select>" * 30_000, "<a '>'" * 30_000 + '"', "<table><tr><td>" * 8_000])
def test_pages_are_read_in_time_in_proportion_to_their_length(page):
    import time
    from vitrine.llm.page_blocks import read_blocks

    began = time.process_time()
    read_blocks(page, lambda state, tag, names: None)
    assert time.process_time() - began < 3


def test_viterbi_finds_the_best_of_all_labellings():
    import itertools
    from vitrine.llm import main_text as m

    model = m.train()

    def score(blocks, labels):
        own = sum(model.weights.get(f, 0.0) for b, y in zip(blocks, labels) if y for f in m.block_features(b))
        return own + model.start[labels[0]] + sum(model.change[x][y] for x, y in zip(labels, labels[1:]))

    for seed in range(900_000_000, 900_000_040):
        blocks = m.labelled_page(seed)[0][:9]
        best = max(score(blocks, labels) for labels in itertools.product((0, 1), repeat=len(blocks)))
        assert score(blocks, [int(x) for x in model.decode(blocks)]) == pytest.approx(best)


def test_empty_tables(spark):
    from vitrine.llm.contamination import contained_items
    from vitrine.llm.language import identify_languages
    from vitrine.llm.line_dedup import dedup_lines
    from vitrine.llm.order_minhash import one_of_each
    from vitrine.llm.packing import pack_documents
    from vitrine.llm.sharding import shard_documents
    from vitrine.llm.tokens import tokens_round_trip
    from vitrine.llm.toxicity import score_toxicity

    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for made in (contained_items(none, items), identify_languages(none), dedup_lines(none), one_of_each(none),
                 pack_documents(none), shard_documents(none), tokens_round_trip(none), score_toxicity(none, labels)):
        assert made.count() == 0
