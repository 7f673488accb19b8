import random
import time

from silvagrid.llm import linededup
from tests.llm.conftest import texts_of


def words(rnd, n):
    return " ".join(f"v{rnd.randrange(10**6)}" for _ in range(n))


def corpus(spark):
    rnd = random.Random(4)
    passage, block = words(rnd, 60), [words(rnd, 15) for _ in range(14)]
    rows = {}
    for i in range(30):
        own = [words(rnd, rnd.randrange(3, 14)) for _ in range(6)]
        if i % 3 == 0:
            own[2:2] = [passage]
        if i % 5 == 0:
            own[4:4] = block
        if i % 2:
            own[0:0] = ["common first line"]
        rows[i] = "\n".join(own)
    rows[40] = rows[41] = "\n".join(words(rnd, 12) for _ in range(8))
    return rows, passage, block, spark.createDataFrame([(k, v, len(v)) for k, v in rows.items()], "doc_id long, text string, n_chars long")


def test_repeated_passages_go_and_the_rest_stays(spark):
    rows, passage, block, df = corpus(spark)
    out = linededup.drop_repeated_lines(df)
    got = {r["doc_id"]: r for r in out.collect()}
    assert [k for k in got if passage in got[k]["text"]] == [0]
    assert rows[0] == got[0]["text"] and got[40]["text"] == rows[40] and len(got[41]["text"]) < 0.4 * len(rows[41])
    for k, r in got.items():
        assert r["n_chars"] == len(r["text"])
        lines = r["text"].split("\n")
        if k % 3 and k % 5 and k < 40:
            assert r["text"] == rows[k]
        if k % 5 == 0 and k:
            assert sum(x in lines for x in block) < 8
        if k < 40:
            assert [x for x in lines if x != passage and x not in block] == [x for x in rows[k].split("\n") if x != passage and x not in block]


def test_boundaries_resist_shifts(spark):
    rnd = random.Random(8)
    lines = [words(rnd, 14) for _ in range(60)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([words(rnd, 5), *lines]))]
    got = linededup.chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    one, two = ({r["h"] for r in got if r["key"] == k} for k in (1, 2))
    assert len(one & two) >= 0.8 * len(one)


def test_all_chunks_against_brute_force(spark, documents):
    got = texts_of(linededup.drop_repeated_lines(documents))
    first, want = {}, {}
    spans = {}
    texts = texts_of(documents)
    for r in linededup.chunks(documents).collect():
        spans.setdefault(r["key"], []).append((r["start"], r["n"]))
    for k in sorted(texts):
        lines, gone = texts[k].split("\n"), set()
        run = []
        for s, n in [*sorted(spans[k]), (len(lines), 0)]:
            if n and first.setdefault("\n".join(lines[s : s + n]), (k, s)) != (k, s):
                run += range(s, s + n)
                continue
            size = sum(lines[i].count(" ") + 1 for i in run)
            if size >= 50 or len(run) > 1 and size >= 20:
                gone |= set(run)
            run = []
        want[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert got == want and got != texts


def test_short_lines_of_repeated_passages_go(spark):
    """Passages of 60 words in lines of under 50, between lines of unrelated documents."""
    rnd = random.Random(12)
    rows, want = {}, {}
    for case in range(40):
        n = (2, 3, 4, 6)[case % 4]
        passage = [words(rnd, 60 // n) for _ in range(n)]
        for k in (2 * case, 2 * case + 1):
            before, after = ([words(rnd, rnd.randrange(3, 14)) for _ in range(rnd.randrange(4))] for _ in range(2))
            rows[k] = "\n".join([*before, *passage, *after])
            want[k] = rows[k] if k % 2 == 0 else "\n".join([*before, *after])
    line, pair = words(rnd, 15), [words(rnd, 9) for _ in range(2)]
    rows[100], want[100] = "\n".join([line] * 6), "\n".join([line] * 2)
    for k in (101, 102):  # too few words
        rows[k] = want[k] = "\n".join([words(rnd, 9), *pair, words(rnd, 9)])
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert texts_of(linededup.drop_repeated_lines(df, linededup.Chunking(any_line=True))) == want


def test_no_run_that_occurred_before_is_left(spark, documents):
    got, seen, want = texts_of(linededup.drop_repeated_lines(documents, linededup.Chunking(any_line=True))), {}, {}
    texts = texts_of(documents)
    for k in sorted(texts):
        lines, gone = texts[k].split("\n"), set()
        for s in range(len(lines)):
            size = 0
            for e in range(s + 1, len(lines) + 1):
                size += lines[e - 1].count(" ") + 1
                if size >= 50 or e - s > 1 and size >= 20:
                    doc, at = seen.setdefault("\n".join(lines[s:e]), (k, s))
                    if (doc, at) == (k, s):
                        break  # nor did any longer run occur
                    gone |= set(range(max(s, at + e - s) if doc == k else s, e))
        want[k] = [x for i, x in enumerate(lines) if i not in gone]
    for k, lines in want.items():
        left = iter(lines)
        assert all(x in left for x in got[k].split("\n")) or got[k] == ""


def test_odd_rows(odd, none):
    out = linededup.drop_repeated_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    got = {}
    for r in out.collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert got[3] == [None] and got[4] == [""] and len(got[1]) == 2
    assert linededup.drop_repeated_lines(none).count() == 0


def test_no_python_in_the_plan(documents):
    plan = linededup.drop_repeated_lines(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan


def test_scripts_without_spaces_and_blank_lines(spark):
    chinese = "\n".join("".join(chr(0x4E00 + (37 * i + 11 * j) % 5000) for j in range(40)) for i in range(8))
    rows = [(1, f"first\n{chinese}\nend"), (2, f"second start\n{chinese}\nother end"), (3, "a\n" + "\n" * 30 + "b"), (4, "c\n" + " \n" * 30 + "\n" * 30 + "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.drop_repeated_lines(docs, linededup.Chunking(any_line=True)).collect()}
    assert got == {1: rows[0][1], 2: "second start\nother end", 3: rows[2][1], 4: rows[3][1]}


def test_many_lines_take_time_in_proportion(spark):
    def seconds(n):
        text = "\n".join(f"line {i * 7919 % 1000003} of a long repeated text with some words in it" for i in range(n))
        docs = spark.createDataFrame([(1, text), (2, text + "\nand more")], "doc_id long, text string")
        start = time.time()
        got = {r["doc_id"]: r["text"] for r in linededup.drop_repeated_lines(docs, linededup.Chunking(any_line=True)).collect()}
        assert got[1] == text and got[2] == "and more"
        return time.time() - start

    seconds(1000)
    assert seconds(40_000) < 4 * seconds(10_000) + 5
