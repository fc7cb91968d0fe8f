import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import cooccurrence, hotjoin, leakage, packing, pairs, repetition, residue, termstats, textnorm, tokenise, truncation

TAGS = "repo string, item string, tags array<string>"


@pytest.fixture(scope="module")
def items():
    rnd = random.Random(3)
    rows = [("r", f"i{rnd.randrange(60)}", [rnd.choice(["Solo", " solo", "a_bc", "A bc", "x", "", None, "y_y", "dd"]) for _ in range(rnd.randrange(5))]) for _ in range(150)]
    return rows + [("r", "i0", None), (None, None, ["x", "solo"]), ("r", "i1", [])]


def by_item(rows):
    out = {}
    for repo, item, tags in rows:
        for t in tags or ():
            t = (t or "").strip().lower()
            t = t.replace("_", " ") if len(t) > 3 else t
            if t:
                out.setdefault((repo, item), set()).add(t)
    return out


def test_pairs_of_tags(spark, items):
    held = by_item(items)
    want = Counter(p for tags in held.values() for p in itertools.combinations(sorted(tags), 2))
    df = spark.createDataFrame(items, TAGS)
    got = {(r["tag_a"], r["tag_b"]): r["n_ab"] for r in cooccurrence.pair_counts(df).collect()}
    assert got == want
    some = {(r["tag_a"], r["tag_b"]): r["n_ab"] for r in cooccurrence.pair_counts(df, 9, 4).collect()}
    assert some == {p: c for p, c in want.items() if c >= 9 and c * 4 >= len(held)}
    assert cooccurrence.companions(df.limit(0)).count() == 0


def test_terms(spark, items):
    held = by_item(items)
    want = Counter(t for tags in held.values() for t in tags)
    got = {r["tag"]: (r["items"], r["n"]) for r in termstats.term_counts(spark.createDataFrame(items, TAGS)).collect()}
    assert got == {t: (c, len(held)) for t, c in want.items()}
    for hot in (0, 3):
        assert {r["tag"]: (r["items"], r["n"]) for r in termstats.term_counts(spark.createDataFrame(items, TAGS), hot=hot).collect()} == got
    assert termstats.term_counts(spark.createDataFrame([], TAGS)).count() == 0
    df = spark.createDataFrame(items, TAGS)
    for r in termstats.bitmaps(df, termstats.spellings(df)).collect():
        assert len(set(termstats.places(r["bits"]))) == r["items"]
    for n in (0, 5, termstats.DENSE - 1, termstats.DENSE, termstats.RECORDS):
        assert termstats.places(termstats.container(np.arange(n))).tolist() == list(range(n))


def test_repetition(spark):
    rnd = random.Random(5)
    texts = [None, "", "a b c", "spam " * 30, "猫、" * 20] + [" ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(5, 60))) for _ in range(200)]

    def share(t):
        w = repetition.words(t or "")
        seen, hit = set(), set()
        for i in range(len(w) - 3):
            g = tuple(w[i : i + 4])
            if g in seen:
                hit.update(range(i, i + 4))
            seen.add(g)
        return len(w), len(hit)

    df = spark.createDataFrame(list(enumerate(texts)), "caption_id bigint, caption string")
    assert {r["caption_id"]: (r["words"], r["repeated"]) for r in repetition.repetition(df, df.limit(0), trusted_text="caption").collect()} == {i: share(t) for i, t in enumerate(texts)}
    want = {i for i, t in enumerate(texts) if share(t)[0] >= 12 and share(t)[1] * 10 >= 4 * share(t)[0]}
    # No case is lost whatever is trusted: nothing, what has no repeats, what has some, the corpus itself.
    said = ["", *(" ".join(rnd.sample("abcdefghijklmnop", 14)) for _ in range(9)), "a b c d e a b c d e f g"]
    for trusted in ([None], said[:10], said, texts):
        good = spark.createDataFrame([(t,) for t in trusted], "text string")
        assert {r[0] for r in repetition.repetitive(df, good).collect()} == want and want
    few = repetition.repetition(df, spark.createDataFrame([(t,) for t in said[:10]], "text string"), every=False).collect()
    assert want <= {r["caption_id"] for r in few if r["suspect"]} < {i for i, t in enumerate(texts) if share(t)[1]}
    assert all((r["repeated"] is not None) == r["suspect"] for r in few)


def test_common_subsequences():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            left = 0
            for j, y in enumerate(b, 1):
                left, row[j] = row[j], (left + 1 if x == y else max(row[j], row[j - 1]))
        return row[-1]

    rnd = random.Random(1)
    for _ in range(2000):
        a, b = (rnd.choices("abcde", k=rnd.randrange(12)) for _ in range(2))
        assert pairs.lcs(a, b) == slow(a, b)


def test_packing(spark):
    rnd = random.Random(2)
    rows = [("r", f"f{i}", rnd.choice([0, 5, 40, 250, rnd.randrange(1, 90)]), "2024-01-01") for i in range(300)] + [("r", "gone", None, "2024-01-01"), ("s", "neg", -1, "2024-01-01"), ("r", "a/../f1", 90, "2024-01-02"), (None, "n", 3, None)]
    df = spark.createDataFrame(rows, "repo string, rel string, size bigint, t string").select("repo", "rel", "size", F.col("t").cast("timestamp_ntz").alias("listed_at"))
    out = packing.pack(df, 100, 80).collect()
    room = Counter()
    for r in out:
        if r["shard"]:
            room[r["shard"]] += r["part_size"]
    assert max(room.values()) <= 100 and sum(room.values()) / (100 * len(room)) > 0.95
    whole = Counter()
    for r in out:
        whole[r["repo"], r["rel"]] += r["part_size"] or 0
    assert whole["r", "f1"] == 90 and len(whole) == 303
    assert all((r["parts"] > 1) == ((r["size"] or 0) > 100) for r in out)
    assert {(r["repo"], r["rel"]) for r in out if r["shard"] is None} == {("r", "gone"), ("s", "neg")}
    assert packing.pack(df.limit(0)).count() == 0


def test_tokens(spark):
    texts = [None, "", "Hello world, it's 2024!", "  spaces \n\n\t x", "日本語 ąé 🎮👩‍🎨", "<|endoftext|>", "a" * 5000, "rare-word qzxv qzxv"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, "")], "doc_id bigint, text string")
    encoded = tokenise.encode_corpus(df, hot_words=3)
    got = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_file(tokenise.VOCABULARY.replace(".tiktoken", ".json"))
    whole.encode_special_tokens = True
    assert got == {i: whole.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["text"] for r in tokenise.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_leaks(spark):
    item = "Only Vera noticed that panel 4540 hid one violet apron painted by Radu in 916 strokes near the quiet harbour wall."
    words = item.split()
    texts = [None, "", item.upper(), "x " + " ".join(words[3:15]) + " y", "x " + " ".join(words[3:14]) + " y", item.replace("violet", "vio-\nlet").replace(" ", "  "), "".join(f"**{w}** " for w in words), item.replace("o", "ö").encode().decode("latin1"), item.replace("a", "\\u0061")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (7, item), (10, item.upper() + " End."), (None, item)], "item_id bigint, text string")
    # Repeated rows, one id with two texts, and a null id.
    df = df.union(df).union(spark.createDataFrame([(2, "other"), (None, item)], df.schema))
    for local in (0, 10_000):
        got = [(r["doc_id"], r["item_id"]) for r in leakage.leaks(df, items, local=local).collect()]
        assert set(got) == {(i, k) for i in (2, 3, 5, 6, 7, 8, None) for k in (7, 10, None)} and len(got) == 21
    assert leakage.leaks(df.limit(0), items).count() == 0
    assert textnorm.canonical_words("ｆｕｌｌ　ｗｉｄｔｈ &eacute; é a​b") == ["full", "width", "e", "e", "ab"]


def captions():
    rnd = random.Random(4)
    colours, things, places = ["red", "blue", "teal", "grey"], ["kite", "lamp", "boot", "drum"], ["stone bridge", "quiet kitchen", "tram stop", "wheat field"]
    say = lambda: f"A {rnd.choice(colours)} {rnd.choice(things)} hangs beside the {rnd.choice(places)}."
    rows = [(i, "r", "en", "Describe the frame with the tags red kite and blue lamp in English please.", " ".join(say() for _ in range(3))) for i in range(600)]
    odd = [None, " ", "n/a", '{"caption": ""}', "```json\n```", "A red kite hangs beside the stone bri", "A blue lamp hangs beside the tram stop. A teal dr…", '{"caption": "A red kite hangs', "I'm sorry, but I can't describe this image.", "> Describe the frame with the tags red kite and blue lamp in English please.", 'A sign reads "I cannot help you". ' + say(), say()[:-1]]
    return rows + [(1000 + i, f"q{i}", "en", rows[0][3], c) for i, c in enumerate(odd)]


def test_truncation_and_defects(spark):
    cap = spark.createDataFrame(captions(), "caption_id bigint, request_id string, lang string, prompt string, caption string")
    log = spark.createDataFrame([(1, "q0", "b", "model declined to answer: outside of the rules", 2.0), (2, "q0", "b", None, 1.0), (3, "q1", "b", "connection reset by peer", 1.0)] + [(10 + i, f"z{i}", "b", ("connection reset by peer", "model declined to answer: outside of the rules")[i % 2], 1.0) for i in range(50)], "log_id bigint, request_id string, batch_id string, error_message string, updated_at double")
    cut = {(r["field"], r["row_id"]) for r in truncation.truncated(cap, log).collect()}
    assert cut == {("caption", 1005), ("caption", 1006), ("caption", 1007)}
    found = {r["caption_id"]: r["defect"] for r in pairs.defects(cap, log).collect()}
    assert found == {1000: "refusal", 1001: "empty", 1002: "empty", 1003: "empty", 1004: "empty", 1005: "truncated", 1006: "truncated", 1007: "truncated", 1008: "refusal", 1009: "echo"}


def test_thresholds_are_fitted_for_any_field(spark):
    """From held-out cuts and complete values, for fields and languages of any name."""
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefghijklmnop", k=5)) for _ in range(40)]
    say = lambda: " ".join([*rnd.choices(words[:30], k=8), rnd.choice(words[30:])])
    rows = [("note", i, None if i % 2 else "xx", f"{say()}. {say()}.") for i in range(800)] + [("note", 9000 + i, "xx", f"{say()}. {say()[:-9]}") for i in range(20)] + [("note", 9900, "xx", None)]
    df = spark.createDataFrame(rows, "field string, row_id bigint, lang string, text string")
    scores = truncation.truncation_scores(df).collect()
    assert len(scores) == 820 and {r["row_id"] for r in scores if r["cut"]} == set(range(9000, 9020))
    assert len({r["threshold"] for r in scores}) <= 2 and truncation.truncation_scores(df.limit(0)).count() == 0
    n = np.zeros(100)
    n[10], m = 1000, np.zeros(100)
    m[50] = 1000
    assert 29 < truncation.expected_threshold(n, m) < 32 and truncation.expected_threshold(n * 0, m * 0) == 50
    assert truncation.expected_threshold(m, n) < 11 and 29 < truncation.expected_threshold(m, n, False) < 32


def test_every_complete_value_is_cut_once(spark):
    """Not a sample: also of more values than a few thousand of one field and language."""
    rows = [("caption", i, "en", f"The {'abcdefg'[i % 7]}{i} kite hangs. It is number {i * 7919 % 10007} of them all.") for i in range(7000)]
    odd = [("caption", 9000, "en", "Too short."), ("caption", 9001, "en", "This one has no stop and isn't complete"), ("caption", 9002, None, '{"caption": "In JSON, no prose."}')]
    df = spark.createDataFrame(rows + odd, "field string, row_id bigint, lang string, text string")
    held = Counter(r["row_id"] for r in truncation._tails(df).where("held").select("row_id").collect())
    assert held == {i: 1 for _, i, _, t in rows if truncation.cut_of(t, False)} and len(held) > 5500


def test_thresholds_see_every_cut_and_every_complete_value(spark, monkeypatch):
    rows = [("error_message", i, "en", f"Worker {'abcdefg'[i % 7]} lost kite {i * 31} on the long way home, then gave up.") for i in range(6000)]
    rows += [("caption", i, "xy", "A kite hangs beside the lamp. A boot stands there.") for i in range(700)]
    seen, fit = [], truncation.expected_threshold
    monkeypatch.setattr(truncation, "expected_threshold", lambda cuts, ends, *more: seen.append((int(cuts.sum()), int(ends.sum()))) or fit(cuts, ends, *more))
    truncation.truncation_scores(spark.createDataFrame(rows, "field string, row_id bigint, lang string, text string"))
    cuts = [sum(truncation.cut_of(t, f == "error_message") is not None for f, _, _, t in rows if f == field) for field in ("caption", "error_message")]
    assert seen == list(zip(cuts, (700, 6000))) and cuts[1] > 5500


def test_contexts_are_looked_up_from_the_shortest():
    rnd = random.Random(12)
    texts = ["".join(rnd.choices("abc .!?…。\"')」,、x", k=rnd.randrange(1, 90))).rstrip() or "a" for _ in range(200)]
    forms, fields = [truncation.form_of(t) for t in texts], ["caption"] * len(texts)
    for orders, _, chunk in truncation._grouped(fields, forms, texts, False):
        stop = np.zeros(len(chunk.codes) + 1, bool)
        for m in truncation._STOPS.finditer(chunk.joined):
            stop[m.start() : m.end()] = True
        assert truncation._stop_places(chunk.codes)[0].tolist() == stop.tolist()
        asked = Counter()
        for known in (set(), None):
            looked = []
            passes = lambda h: looked.append(len(h)) or np.full(len(h), known is None)  # noqa: B023, E731
            asked[known is None] = len(truncation.all_contexts(chunk, orders, forms, fields, passes)[0]), sum(looked[: 2 * len(orders)])
        # What no value ends with isn't looked up in its longer contexts; with all let pass nothing is left out.
        places = [int(n) for n in chunk.lengths]
        assert asked[False] == (0, sum(max(0, n - orders[0]) for n in places) + sum(f == "json" and n >= orders[0] for f, n in zip(forms, places)))
        assert asked[True][1] == sum(max(0, n - k) + (f == "json" and n >= k) for f, n in zip(forms, places) for k in orders)


def test_parts_of_responses():
    rnd = random.Random(13)
    for _ in range(300):
        text = "".join(rnd.choices("ab1_ .!?。！\n\r é漢\"“”", k=60))
        apart = pairs.re.split(r"(?<=[.!?])\s+|(?<=[。！？])|[\r\n]+", pairs._QUOTED.sub(" ", text))
        assert [t for t in pairs._sentences(pairs._unquoted(text)) if t.strip()] == [t for t in apart if t and t.strip()]
    assert pairs._trigrams(["a--1b c", "é"])[1].tolist() == [6, 2] and pairs._trigrams(["a--1b c"])[0].tolist() == pairs._trigrams(["A b_c"])[0].tolist()
    assert truncation.normalised(" 12\t a/b \n c ", True) == " 0 / c" and truncation.normalised(" \n ", False) == ""
    long = "Zwölf Boote liegen am Kai. " * 20 + "Ein Kran dreht sich"
    (end, _, orders), (whole, _, _) = truncation.views(long, "caption", True)[0], truncation.views(long, "caption", False)[0]
    assert whole.endswith(end) and orders[-1] <= len(end) < len(whole) / 2


def test_context_lengths():
    assert [v[2] for v in truncation.views("a boat", "caption", True)] == [(3, 5, 8, 12, 20, 32, 48)]
    assert [v[2] for v in truncation.views("no boat", "error_message", False)] == [(3, 5, 8, 12, 20)] * 2


def test_every_language_has_a_model(spark):
    rnd = random.Random(6)
    names = [f"{a}{b}" for a in "klm" for b in "pqrstuv"][:20]
    words = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(30)] for _ in names]
    say = lambda k: " ".join(rnd.choices(words[k], k=40)) + "."
    rows = [(name, say(k)) for k, name in enumerate(names) for _ in range(40 if k < 17 else 20)]
    found, models = pairs.language_models(spark.createDataFrame(rows, "lang string, response string"))
    assert found == names
    assert pairs.foreign_shares([say(19)], [names[19]], found, models)[0] == 0 and pairs.foreign_shares([say(2)], [names[19]], found, models)[0] > 0.5


def test_a_loop_hides_no_other_language(spark):
    rnd = random.Random(8)
    words = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(40)] for _ in range(2)]
    say = lambda k: " ".join(rnd.sample(words[k], 12)) + "."
    names, models = pairs.language_models(spark.createDataFrame([("xy"[k] * 2, say(k)) for k in (0, 1) for _ in range(300)], "lang string, response string"))
    loop = " ".join([words[0][0]] * 200) + ". "
    assert pairs.foreign_shares([loop + say(1)], ["xx"], names, models)[0] > 0.5
    assert pairs.foreign_shares([loop + say(0)], ["xx"], names, models)[0] == 0 and pairs.foreign_shares([" "], ["xx"], names, models)[0] == 0


def test_defect_rules():
    assert pairs.lcs(list("abcde"), list("axcye")) == 3
    assert pairs.message_says("Refused by the safety filter (stage 1); no caption was produced") == "refusal"
    assert pairs.message_says("response incomplete (12 tokens written, limit reached), caption field never closed") == "truncated"
    assert pairs.message_says("unknown") is None
    head = "2025-03-04 05:06:07.123 worker-12 batch b-0017 attempt 3 /data/a long/path of many words/and a file name 0001.png - "
    assert pairs.message_says(head + "model declined to answer: outside of the rules") == "refusal"
    assert pairs.message_says(head + head + head + "output truncated at the token limit") == "truncated"
    assert pairs.message_says("connection reset by peer; earlier: model declined to answer") is None
    assert pairs.declines("申し訳ありませんが、この画像を説明することはできません。") and not pairs.declines("He shrugs as if unable to describe what he saw.")


def test_residue(spark):
    prose = "A quiet librarian pours tea near the stone bridge. Grey tones dominate the small frame."
    texts = [None, "", prose, "Lorem ipsum dolor sit amet, consectetur.", "404 Not Found\n\nHome | Help\n\n© 2020 X", f"{prose} The sign reads \"please enable JavaScript\".", "Please enable JavaScript to continue.", "A {{character}} stands near the bridge.", "Use `{name}` where a name goes.", "The set {1, 2, 3} was kept.", prose.replace("tea", "XXXX")]
    df = spark.createDataFrame(list(enumerate(texts)) + [(100 + i, prose) for i in range(1500)], "doc_id bigint, text string")
    assert {r["doc_id"] for r in residue.excluded(df).collect()} == {3, 4, 6, 7, 10}
    assert residue.residues(df).count() == 1511


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"caption": "' + "A boat lies still. " * 15 + 'It ends.", @@TAGS@@ ["white cloak"], "style": %s wash"}', ["@@TAGS@@", "%s"]),
        ('{"profile": "anime", "template": "v2", "caption": "A {name} stands near the bridge."}', ["{name}"]),
        ("A {{profile}} stands near the bridge.", ["{{profile}}"]),
        ("A ${template} and a [PLACEHOLDER] hang there.", ["${template}", "[PLACEHOLDER]"]),
        ('{"caption": "One. Two {name}, three.", "tags": ["a"]}', ["{name}"]),
        ('{"caption": "The placeholder {name} is never filled in.", "style": "x"}', []),
        ('{"caption": "A sign reads \\"go {name}\\" there."}', []),
        ('The sign reads "First go. Then {name} follows." at dusk.', []),
        ('"Use {name}." It stood there.', []),
        ('{"caption": "a boat"} Templates use {name} here.', []),
        ("Use `{name}` where a name goes.", []),
        ('{"tags_used": ["crimson kimono", [character name] scarf", %s hat", "red {0}, "blue parasol"], "x": "y"}', ["[character name]", "%s", "{0}"]),
    ],
)
def test_slots(text, want):
    assert residue.slots(text) == want


def test_hot_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(90)] + [(k, 0) for k in range(2, 12)] + [(None, 5)], "k bigint, v int")
    right = spark.createDataFrame([(k, f"x{k}") for k in range(1, 8)], "k bigint, w string")
    got = sorted(map(tuple, hotjoin.join_unique(left, right, "k", 4).collect()), key=str)
    assert got == sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
