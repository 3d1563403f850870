import random

import pytest
from pyspark.sql import functions as F

from cairnlake.llm import packing, residue, tokens

DOC = "doc_id bigint, text string, court string, ids string"


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder("byte_bpe_50k")


def test_tree_is_the_flat_encoding(enc):
    random.seed(3)
    alphabet = "ab AB\n\t  é中文1२.,'s!'́<|endoftext|>I'm we'll \r\n\n x" + chr(0x200B) + "😀"
    for _ in range(1500):
        s = "".join(random.choice(alphabet) for _ in range(random.randint(0, 150)))
        assert enc.encode(s, random.choice([1, 2, 3, 7, 16, 40])) == enc.flat(s)
        assert enc.decode(enc.flat(s)) == s
    for s in ("a" * 5000, " " * 3000, "\n" * 3001, "中" * 2000, "1" * 999, "x'" * 700, "!?" * 800, "word " * 4000, " \n" * 900 + "end"):
        assert enc.encode(s, 64) == enc.flat(s)


def test_encoded_rows(spark, enc):
    rows = [(1, None, None, "clash"), (2, "", None, ""), (3, "<|endoftext|> hi", None, ""), (3, "<|endoftext|> hi", None, ""), (None, "no id", None, ""), (5, "long " * 20_000, None, "")]
    got = tokens.encoded(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(map(repr, got)) == sorted(repr(type(got[0])(doc_id=i, ids=enc.flat(t or ""))) for i, t, _, _ in rows)
    assert tokens.encoded(spark.createDataFrame([], DOC)).collect() == []


def best_sum(room, sizes):
    sums = {0}
    for n in sizes:
        sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_fullest_is_optimal():
    random.seed(1)
    for _ in range(300):
        room = random.randint(1, 60)
        sizes = [random.randint(1, 40) for _ in range(random.randint(0, 12))]
        counts = {n: sizes.count(n) for n in sizes}
        got = packing.fullest(room, sorted(counts, reverse=True), counts)
        assert sum(got) == best_sum(room, sizes) and all(got.count(n) <= counts[n] for n in got)


def test_pack_keeps_items_whole():
    random.seed(2)
    for cap in (1, 7, 100, 1024):
        sizes = [random.choice([0, 1, cap, cap + 1, 3 * cap, random.randint(0, 2 * cap)]) for _ in range(300)]
        bins = packing.pack(sizes, cap)
        assert all(sum(n for *_, n in b) <= cap for b in bins)
        pieces = sorted(p for b in bins for p in b)
        for i, n in enumerate(sizes):
            own = [p for p in pieces if p[0] == i]
            assert sum(p[2] for p in own) == n and own and (len(own) == 1 or n > cap)
            at = 0
            for _, a, m in own:
                assert a == at
                at += m
        if cap == 1024:
            assert len(bins) <= -(-sum(sizes) // cap) * 1.02 + 1
    assert packing.pack([], 5) == [] and packing.pack([0, 0], 5) == [[(0, 0, 0), (1, 0, 0)]]


def test_packed_table(spark):
    sizes = [(i % 50 if i % 3 else 7, "t", (i * 37) % 900) for i in range(400)] + [(None, "t", 10), (999, "other", 5)]
    s = spark.createDataFrame(sizes, "doc_id bigint, tokenizer string, n_tokens bigint")
    b = spark.createDataFrame([("small", "t", 256), ("large", "t", 2000), ("none", "t", None), ("zero", "t", 0)], "budget_name string, tokenizer string, capacity_tokens int")
    out = packing.packed(s, b, block=64)
    per = out.groupBy("budget_name", "container", "capacity_tokens").agg(F.sum("n_tokens").alias("n"))
    assert per.where("n > capacity_tokens").count() == 0
    got = {r["budget_name"]: (r["n"], r["items"]) for r in out.groupBy("budget_name").agg(F.sum("n_tokens").alias("n"), F.count_distinct(F.struct(F.coalesce("doc_id", F.lit(-1)), "copy")).alias("items")).collect()}
    total = sum(n for _, t, n in sizes if t == "t")
    assert got == {"small": (total, 401), "large": (total, 401)}
    assert packing.packed(s.limit(0), b).collect() == []


GOOD = [
    "HIGH COURT\n\n[1] The clause still read \"[insert date]\" when A. B. signed it, and the parties differ.\n\n[2] Costs follow.",
    "HIGH COURT\n\n[1] On 3 May the portal answered \"404 – page not found\", so the bid went by post.\n\n[2] So held.",
    "Landgericht\n\n(1) Das Portal meldete «Fehler 500»; die Klägerin reichte per Post ein.\n(2) Das genügt.",
    "COURT\n\n1. The designer was paid for pages of lorem ipsum filler, never replaced as promised.\n2. So held.",
    "COURT\n\n1. It was put to [REDACTED] and X.____ that the set {A, B, C} of parcels [Schedule 9] <see plan> is [name withheld]'s.\n2. ■■■ agreed.\n\n______________________\nJudge",
    "COURT\n\n1. That reasoning discloses no error of principle, and the finding was open on the evidence.\n2. None of them was null and void.",
    "COURT\n\n1. The site told users to \"enable JavaScript to continue\", a notice that Y could not get past.\n2. Held.",
    "COURT\n\n1. The string \"<|endoftext|>\" means nothing here; the maxim res ipsa loquitur is of no help where the dolor suffered came first.\n2. Held.",
    None, "", "   \n ",
]
BAD = [
    "HIGH COURT\n\n[1] The appellant, {{ party_name }}, contends otherwise.\n\n[2] Costs.",
    "HIGH COURT\nBefore: <%= judge %>\n1. Held.\n2. Held.",
    "COURT\n\n1. Award varied to %(amount)s.\n2. Held.", "COURT\n\n1. Award varied to @@AMOUNT@@.\n2. Held.", "COURT\n\n1. Costs to [TBC: case number].\n2. Held.", "COURT\n\n1. It was put to «FIELD_7», and denied.\n2. Held.",
    "COURT\nDecided: NaN\n1. Held.\n2. Held.", "COURT\n\n1. Paid by [object Object] on #REF!.\n2. Held.", "LG\nVerkündet am: [Datum folgt]\n1. So.\n2. So.", "COURT\n1. the contract of {% if party %} was not terminated.\n2. Held.",
    "COURT\n\n1. Held.\n\n2. Skip to content\n\nYou need to allow scripts and cookies to continue.\n\n3. Held.", "Error 503: Too many requests, slow down", "Die Skriptausführung ist in Ihrem Browser abgeschaltet.",
    "COURT\n\n1. Aliqua volup enim quorat pariat pellor sit lorem ipsum dolor.\n2. Held.", "test test test test test test test test", "COURT\n1. This is sample text. This is sample text. This is sample text.\n2. Held.", "xxx xxx xxxx xx xxx xxx xxxx xx",
]


NOTATIONS = ["{{ price }}", "<%= price %>", "%(price)s", "@@price@@", "[insert price]", "«PRICE_1»", "NaN", "#N/A", "{% price %}"]
TAUGHT = [
    "Skip to content\n\nYou need to allow scripts and cookies to continue.", "Error 401: Too many requests, slow down", "Die Skriptausführung ist in Ihrem Browser abgeschaltet.",
    "Enim pellor quorat dolor aliqua lorem. Volup pariat sit ipsum aliqua dolor enim.",
]


def test_residue_cases(spark, tmp_path):
    rows = [(i, t, "HIGH COURT", "x") for i, t in enumerate(GOOD)] + [(100 + i, t, None, "x") for i, t in enumerate(BAD)] + [(100, BAD[0], None, "x")]
    # What pages teach is taught by pages: each of these twice, without paragraphs.
    rows += [(200 + i, t, None, "x") for i, t in enumerate(TAUGHT * 2)]
    rows += [(300 + i, f"HIGH COURT\n1. {t} of {i} is in the main not to be had, and so on.\n2. Held.", None, "x") for i, t in enumerate(["The first", "A second", "The other", "The whole", "None", "Most"] * 3)]
    # What slots teach: records of one template that differ in what they have in one place.
    rows += [(400 + i, f"COURT\n1. The price agreed by them was {m} in full.\n2. Held.", None, "x") for i, m in enumerate(NOTATIONS)]
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    got = sorted(r["doc_id"] for r in residue.judged(spark.createDataFrame(rows, DOC)).collect())
    assert got == [100 + i for i in range(len(BAD))] + [200 + i for i in range(2 * len(TAUGHT))] + [400 + i for i in range(len(NOTATIONS))]
    assert residue.judged(spark.createDataFrame([], DOC)).collect() == []


def test_alignment_tells_slots_from_wording(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    fixed = [(i, f"COURT {i}\n1. Party {i} says the merge field {{{{client_name}}}} was printed on {i} letters.\n2. Held {i}.", None, "") for i in range(6)]
    slots = [(50 + i, f"COURT {i}\n1. The judge below, {m}, found Party {i} to be careful.\n2. Held {i}.", None, "") for i, m in enumerate(["{{judge}}", "[[judge]]", "@@JUDGE@@", "{{judge}}"])]
    copies = [(90, "COURT 9\n1. Award varied to {{amount}} today.\n2. Held 9.", None, ""), (91, "COURT 9\n1. Award varied to {{amount}} today.\n2. Held 9.", None, ""), (92, "COURT 9\n1. Award varied to {{amount}} today.\n2. Held 9.", None, "")]
    got = sorted(r["doc_id"] for r in residue.judged(spark.createDataFrame(fixed + slots + copies, DOC)).collect())
    assert got == [50, 51, 52, 53, 90, 91, 92]


def test_page_templates(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    pages = [(i, f"Der Viewer wurde angehalten {i}\nBitte laden Sie neu, Kennung {i}a{i}", None, "") for i in range(4)] + [(9, "A single line of a ruling about a quay.", None, "")]
    assert sorted(r["doc_id"] for r in residue.judged(spark.createDataFrame(pages, DOC)).collect()) == [0, 1, 2, 3]


def test_a_filled_place_is_a_slot_whatever_its_default(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    schema = DOC + ", docket string"
    left = [(i, f"COURT {i}\n1. The judge below, {{{{judge}}}}, found Party {i} to be careful.\n2. Held {i}.", None, "", f"D{i}") for i in range(5)]
    filled = [(10, "COURT 10\n1. The judge below, Ada Torberg, found Party 10 to be careful.\n2. Held.", None, "", "D10")]
    versions = [(20 + i, f"COURT 7\n1. The sum of{e}{{{{sum}}}}{e}was paid over late by them.\n2. Held.", None, "", "D20") for i, e in enumerate([" ", "\n", " \n", "\r\n"])]
    scans = [(30 + i, f"COURT 7\n1. The sum due on{e}{{{{day}}}}{e}was paid over late by them.\n2. Held.", None, "", None) for i, e in enumerate([" ", "\n", " \n", "\r\n"])]
    fixed = [(40 + i, f"COURT {i}\n1. Party {i} says the merge field {{{{client_name}}}} was printed on {i} letters.\n2. Held {i}.", None, "", f"E{i}") for i in range(3)]
    left += [(60 + i, f"COURT | list\n1. Costs follow | due by {{{{day}}}} | as agreed in case {i}.\n2. Held.", None, "", f"F{i}") for i in range(2)]
    filled += [(70, "COURT | list\n1. Costs follow | due by 3 May | as agreed in case 9.\n2. Held.", None, "", "F9")]
    got = sorted(r["doc_id"] for r in residue.judged(spark.createDataFrame(left + filled + versions + scans + fixed, schema)).collect())
    assert got == [0, 1, 2, 3, 4, 20, 21, 22, 23, 30, 31, 32, 33, 60, 61]


def test_verbatim_pages_and_ordinary_sentences(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    pages = [(i, "Der Viewer wurde angehalten, bitte laden Sie neu", None, "") for i in range(4)]
    short = [(10 + i, f"HIGH COURT\nParty {w} was heard.\nThe appeal is dismissed with costs.", None, "") for i, w in enumerate(["Ada", "Bo", "Cid"])]
    long = [(20 + i, f"HIGH COURT\n1. The {w} is old; a party was heard.\n2. The appeal is dismissed with costs.", None, "") for i, w in enumerate(["quay", "mill", "barn", "weir"])]
    got = sorted(r["doc_id"] for r in residue.judged(spark.createDataFrame(pages + short + long, DOC)).collect())
    assert got == [0, 1, 2, 3]


def test_filler_between_sentences_in_lines_of_any_length():
    real = "The lease ran for ten years. {} The landlord then gave notice in writing to each of the tenants."
    for bad in ("The rent was test test test test a year.", "This is sample text. This is sample text."):
        for more in ("", " The court heard both parties at length on the point of notice." * 9):
            assert residue.repeats(residue.sentences("COURT\n1. " + real.format(bad) + more + "\n2. Held."))
    assert not residue.repeats(residue.sentences("COURT\n1. " + real.format("It was, it was said, no bar.") + "\n2. Held."))


def test_pages_in_a_language_nobody_listed(spark, tmp_path):
    """Made-up words: pages teach the wording, and it is found among paragraphs, in capitals and beside navigation, but not where it is quoted."""
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    random.seed(5)
    heads, nouns, faults = ["Vosk", "Tumo {n}", "Grelle {n}:"], ["Ol paterik", "Sa vunda", "Il dresko {n}a"], ["neva hurat", "pa brinta solem", "tok i mervin lasto"]
    wrong = lambda: f"{random.choice(heads)} {random.choice(nouns)} {random.choice(faults)}".replace("{n}", str(random.randint(100, 999)))
    words = "the a court lease quay rent term party sum paid held due claim notice costs order appeal".split()
    plain = lambda: " ".join(random.sample(words, 14)).capitalize() + "."
    body = lambda extra: "HIGH COURT\n" + "\n".join(f"{k}. {t}" for k, t in enumerate([plain(), *extra, plain(), plain()], 1))
    pages = [(i, wrong() + random.choice(["\nRetu al stara", "", "\nFolta | Nirk"]), None, "") for i in range(60)]
    parts = [(1000 + i, body([random.choice([wrong(), wrong().upper()])]), None, "") for i in range(60)]
    quotes = [(2000 + i, body([f'The portal said "{wrong()}" to the party.']), None, "") for i in range(20)]
    good = [(3000 + i, body([]), None, "") for i in range(1500)]
    got = {r["doc_id"] for r in residue.judged(spark.createDataFrame(pages + parts + quotes + good, DOC)).collect()}
    want = {r[0] for r in pages + parts}
    assert len(got & want) >= 0.95 * len(want), len(got & want)
    assert not got - want, sorted(got - want)
