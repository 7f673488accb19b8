import pytest

from silvagrid.llm import decontaminate as d
from silvagrid.llm.queries import QUERIES
from tests.conftest import SF_DIR

ITEM = "Maria Lopez has 12 apples and gives 5 apples to her friend Peter before walking 3 km home with the other 7 apples in a bag"


def kinds(text):
    names = {int(d._NUMBER): "N", int(d._NAME): "A", int(d._UNIT): "U"}
    return "".join(names.get(int(x), ".") for x in d.template(text.encode())[0])


@pytest.mark.parametrize("text,want", [
    ("In 2020 Alice Smith paid 3.5 km for the car. The Bob.", ".NA.NU....A"),
    ("ÉTÉ l'Été École 5km", "..ANU"),
    ("", ""), ("!!", ""), ("he met Élise there", "..A."), ("12", "N"), ("km", "."),
])
def test_template(text, want):
    assert kinds(text) == want


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM, "x"), (2, "tiny item of five words", "x"), (3, None, "x"), (4, "", "x"), (None, "a nameless item here now", "x")], "item_id long, text string, slots string")


def leaks(spark, bench, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["changed"] for r in d.find_leaks(df, bench).collect()}


def test_verbatim_and_changed_questions(spark, bench):
    other = ITEM.replace("Maria Lopez", "John").replace("12", "140").replace("5", "66").replace("Peter", "Ann").replace("3", "8").replace("7", "74")
    tail = ITEM.replace("5 apples", "12 apples").replace("Peter", "Maria Lopez")  # 13 tokens at the end stand word for word
    torn = tail.replace("7", "3")
    texts = [f"before. {ITEM} after", f"well, {other}", torn, "nothing of the kind " * 20, "so a tiny item of five words it is", ITEM.lower(), " ".join(ITEM.split()[:6]), tail]
    got = leaks(spark, bench, texts)
    # without capitals the names are plain words, but most windows still agree
    assert set(got) == {(0, 1), (1, 1), (4, 2), (5, 1), (7, 1)} and got[0, 1] == got[7, 1] == 0 and got[1, 1] > 0


LEFT = "the old man went down to the harbour before dawn and asked every sailor whether the ship had been seen"
RIGHT = "then he walked slowly back through the narrow streets to the small house where his wife was waiting for him"
DENSE = {
    1: "Calculate 3 + 5 * 2 - 7.",
    2: f"{LEFT} and paid 40 coins and again 40 coins {RIGHT}",
    3: "2 3 5 7 11 13 17 19 23 29",
    4: ITEM,
    5: "The Lord Of The Rings And The Two Towers By John Ronald Reuel Tolkien",
}


def test_items_dense_in_slots_are_found_word_for_word(spark):
    bench = spark.createDataFrame(list(DENSE.items()), "item_id long, text string")
    texts = [f"so it was written here: {t} and more followed after that" for t in DENSE.values()]
    texts[1] = texts[1].replace("again 40", "again 41")  # one of two equal values changed
    others = ["Calculate 3 + 5 * 2 - 8.", "2 3 5 7 11 13 17 19 23 31", "The Lord Of The Rings", "nothing of all that is here", "Calculate 3 + 5"]
    got = leaks(spark, bench, texts + others)
    assert set(got) == {(i, i + 1) for i in range(5)}


def brute(texts, items, p=d.Templates()):
    """Every window of every document against every window of every item."""
    found = set()
    for k, t in texts.items():
        tokens, values, slot = d.template((t or "").encode())
        for item, u in items.items():
            theirs, their_values, their_slot = d.template((u or "").encode())
            size = min(len(theirs), p.window)
            diagonals = {}
            for j in range(len(theirs) - size + 1 if size else 0):
                few = int((~their_slot[j : j + size]).sum()) < d._need(size, p)
                for i in range(len(tokens) - size + 1):
                    if (tokens[i : i + size] == theirs[j : j + size]).all():
                        pairs = [(int(a), int(b)) for a, b, s in zip(their_values[j : j + size], values[i : i + size], slot[i : i + size]) if s]
                        same = all(a == b for a, b in pairs)
                        if same or not few:
                            diagonals.setdefault(i - j, []).append((j, same, [] if few else pairs))
            places = set()
            for rows in diagonals.values():
                pairs = {x for _, _, y in rows for x in y}
                fits = len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
                places |= {x for j, same, _ in rows if fits or same for x in range(j, j + size)}
            if places and len(places) >= min(p.tokens, -(-len(theirs) * 6 // 10)):
                found.add((k, item))
    return found


def test_equals_windows_compared_one_by_one(spark):
    import random

    rnd = random.Random(4)
    words = "the of Anna Berlin 12 7 km a he Carl went 99 kg with every Dora some".split()
    items = {i: " ".join(rnd.choice(words) for _ in range(rnd.choice([2, 5, 9, 14, 30]))) for i in range(25)} | {77: None, 78: ""}
    texts = {}
    for i in range(60):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(12)))]
        for k in rnd.sample(range(25), 2):
            w = items[k].split()
            if i % 3:
                w = [rnd.choice(["12", "99", "5"]) if x.isdigit() else x for x in w]
            parts += [" ".join(w[rnd.randrange(3) : len(w) - rnd.randrange(3)]), "and then"]
        texts[i] = " ".join(parts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, bench).collect()} == brute(texts, items)


def test_query_equals_brute_force(spark, documents):
    grams = {}
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = r["text"].lower().split()
        for i in range(len(w) - 12):
            grams.setdefault(tuple(w[i : i + 13]), set()).add(r["item_id"])
    want = set()
    for r in documents.collect():
        w = r["text"].lower().split()
        for i in range(len(w) - 12):
            want |= {(r["doc_id"], k) for k in grams.get(tuple(w[i : i + 13]), ())}
    assert want <= {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_template_leaks"](spark, SF_DIR).collect()}


def test_odd_rows(spark, odd, none, bench):
    assert d.find_leaks(odd, bench).count() == 0
    kept = d.drop_leaks(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert d.find_leaks(none, bench).count() == 0 and d.find_leaks(odd, bench.limit(0)).count() == 0
