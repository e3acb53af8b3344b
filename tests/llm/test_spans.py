import random
from collections import defaultdict

from pyspark.sql import Row, functions as F

from tallyspark.llm import spans

from . import cases


def brute(rows, least_words=0):
    """(id, text, cleaned text) of every row, with spans compared as strings, not hashes."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, spans_tag(r[1])))
    places = defaultdict(list)
    for row, (_, text) in enumerate(rows):
        parts = [" ".join(p.split()) for p in spans.sentences(text)[0]]
        for at in range(len(parts) - spans.SPAN + 1):
            places[tuple(parts[at : at + spans.SPAN])].append((row, at))
    later = defaultdict(set)
    for found in places.values():
        for row, at in sorted(found)[1:]:
            later[row].add(at)
    out = []
    for row, (doc, text) in enumerate(rows):
        parts, sizes = spans.sentences(text)
        covered = [any(s <= k < s + spans.SPAN for s in later[row]) for k in range(len(parts))]
        keep, k = "", 0
        while k < len(parts):
            end = k
            while end < len(parts) and covered[end] == covered[k]:
                end += 1
            if not covered[k] or sum(sizes[k:end]) < least_words:
                keep += "".join(parts[k:end])
            k = end
        out.append((doc, text, keep))
    return out


def spans_tag(text):
    from pyspark.sql import SparkSession, functions as F

    spark = SparkSession.getActiveSession()
    return spark.range(1).select(F.xxhash64(F.lit(text)).bitwiseAND(F.lit((1 << 31) - 1))).collect()[0][0]


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def cleaned(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return [tuple(r) for r in spans.dedup(docs, **options).collect()]


def test_parts_give_the_text_back():
    texts = [t for _, t in cases.ODD if t] + ["  \n a. b! c?\n\n\td", "\n\n", "one. " + words("w", 30) + ".  two", "a\x1c. b"]
    for text in texts:
        parts, sizes = spans.sentences(text)
        assert "".join(parts) == text and len(parts) == len(sizes)
        assert sum(sizes) == len(text.split()) and max(sizes) <= spans.LONGEST


def test_a_long_passage_goes_from_all_but_the_first_text(spark):
    passage = words("p", 55) + "."
    rows = [(9, f"{words('a', 9)}.\n{passage}\n{words('b', 9)}."), (3, f"{words('c', 30)}.\n{passage}"), (5, passage)]
    found = dict(cleaned(spark, rows))
    assert found == {3: rows[1][1], 5: "", 9: f"{words('a', 9)}.\n{words('b', 9)}."}


def test_passages_that_begin_inside_sentences_go(spark):
    draw = random.Random(7)
    rows, passages = [], []
    for i in range(150):
        passage = [f"w{draw.randrange(3000)}" + draw.choice(["."] + [""] * draw.choice([5, 20, 200])) for _ in range(draw.randint(51, 65))]
        passages.append(passage)
        for copy in range(2):
            before, after = ([f"{side}{i}x{copy}x{k}" for k in range(draw.randint(0, 40))] for side in "ab")
            rows.append((i + 1000 * copy, " ".join(before + passage + after)))
    found = dict(cleaned(spark, rows))
    windows = lambda text: {tuple(text[k : k + 50]) for k in range(len(text) - 49)}
    for i, passage in enumerate(passages):
        first, later = dict(rows)[i], dict(rows)[i + 1000].split()
        left = found[i + 1000].split()
        assert found[i] == first
        assert windows(later) & windows(first.split()) and not windows(left) & windows(first.split())
        own = lambda text: [w for w in text if w[0] != "w"]
        assert own(left) == own(later) and len(left) - len(own(left)) < 2 * spans.LONGEST


def test_one_repeated_word_is_cut_seldom():
    assert len(spans.sentences("ha " * 1200)[0]) <= 120


def test_short_runs_go_unless_a_least_length_is_asked_for(spark):
    own = {i: f"{words(f'd{i}x', 40)}." for i in range(6)}
    rows = [(i, f"Yes. No. Well.\n{own[i]}") for i in own]
    assert dict(cleaned(spark, rows)) == {**own, 0: rows[0][1]}
    assert dict(cleaned(spark, rows, least_words=20)) == dict(rows)


def test_rows_that_repeat_an_id_and_its_text(spark):
    """A third of all rows is one row; one of them keeps its text, later ids lose it too."""
    text = f"{words('a', 30)}. {words('b', 30)}."
    rows = [(1, text)] * 40 + [(None, text)] * 2 + [(i, f"{words(f'd{i}x', 40)}.") for i in range(2, 70)] + [(70, text + " Own end.")]
    found = sorted((str(i), t) for i, t in cleaned(spark, rows))
    assert found == sorted((str(i), t) for i, _, t in brute(rows))
    assert [t for i, t in found if i == "None"] == ["", text] and {t for i, t in found if i == "1"} == {""}
    assert len(cleaned(spark, rows, drop_emptied=True)) == len([t for _, t in found if t])
    reported = spans.dedup(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()
    assert all((r.words_removed == 60) == (r.text in ("", "Own end.")) for r in reported)


def test_repeats_inside_one_text(spark):
    verse = ". ".join(words(c, 9) for c in "xyz") + ".\n"
    assert dict(cleaned(spark, [(1, verse + words("q", 12) + ".\n" + verse)])) == {1: verse + words("q", 12) + ".\n"}


def test_odd_rows(spark):
    want = brute(cases.ODD)
    found = spans.dedup(cases.odd(spark))
    assert found.columns == cases.odd(spark).columns
    rows = found.collect()
    assert sorted((str(r.doc_id), r.text or "") for r in rows) == sorted((str(i), t) for i, _, t in want)
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert spans.dedup(cases.empty(spark)).count() == 0


def test_columns_of_any_name_pass_through(spark):
    rows = [(i, t, "x", ("y", 2)) for i, t in cases.ODD]
    names = ["__text", "__tag", "__starts", "__full", "c0", "id", "tag", "parts", "number", "my col", "meta:url", "q`t"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, plain string, nested struct<`a b`: string, n: int>")
    docs = docs.select("*", *[F.lit(n).alias(n) for n in names])
    found = spans.dedup(docs)
    assert found.columns == docs.columns
    got = found.collect()
    assert len(got) == len(rows) and all(list(r)[2:] == ["x", Row(**{"a b": "y", "n": 2}), *names] for r in got)


@cases.needs_data
def test_query(spark):
    from tallyspark.llm.queries import op7_substring_dedup

    rows = cases.documents(spark)
    found = op7_substring_dedup(spark, cases.DATA).collect()
    want = brute(rows)
    assert sorted((r.doc_id, r.text) for r in found) == sorted((i, t) for i, _, t in want)
    assert {r.doc_id: r.n_sentences for r in found} == {i: spans.span_hashes(t)[0] for i, t in rows}
    assert all((r.n_removed == 0) == (r.text == dict(rows)[r.doc_id]) for r in found)
