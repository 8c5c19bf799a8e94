import base64
import random
import re

import public_tokenizers as P
import pytest
import tiktoken

from ledgerloom.llm import mixing, pii, pii_table, queries, tokens


@pytest.fixture(scope="module")
def vocab():
    return tokens.vocabulary(tokens.default_path())


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed):
    r = random.Random(seed)
    parts = ["the ", "Ünïcödé", "退職給付", "引当金", "한글 ", "\n\n", "  ", "1234", "😀", "<|endoftext|>", "it's", "\t", "\u200d", "aaaaaaaa", "\x00", "ー"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_ids_are_those_of_the_public_tokenizer(vocab, known):
    for t in [*texts(400, 1), "x" * 5000, "退" * 3000, ""]:
        ids = list(vocab.encode(t))
        assert ids == known.encode_ordinary(t)
        assert vocab.decode(ids) == t


def test_every_prefix_and_appends(vocab, known):
    data = "unbelievablyinternationalization退職給付".encode()
    table = tokens.PrefixTable(vocab)
    for i in range(len(data)):
        table.append(data[i : i + 1])
        assert table.ids() == vocab.merged(data[: i + 1])
    assert all(table.ids(i) == vocab.merged(data[:i]) for i in range(1, len(data)))


def test_edits_encode_only_near_them(vocab, known):
    r = random.Random(2)
    for t in texts(80, 3):
        e = tokens.EncodedText(vocab, t)
        for _ in range(4):
            i = r.randint(0, len(e.text))
            e.edit(i, min(len(e.text), i + r.randint(0, 5)), r.choice(["", "a", " b", "職", "\n "]))
            assert e.ids() == known.encode_ordinary(e.text)
    long = tokens.EncodedText(vocab, "word " * 2000)
    before = long.encoded
    long.edit(5000, 5001, "x")
    assert long.encoded - before < 10


def test_null_and_empty_texts(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "hello world", "x")], "doc_id bigint, text string, ids string")
    assert {r["doc_id"]: list(r["ids"]) for r in tokens.token_ids(d).collect()} == {1: [], 2: [], 3: [31373, 995]}
    assert tokens.token_ids(d.limit(0)).count() == 0


# Mixing


def sizes(spark, **per):
    rows = [(i, s, 10 + i % 7) for s, (a, b) in per.items() for i in range(a, b)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def test_targets_are_met_and_caps_kept(spark):
    s = sizes(spark, a=(0, 4000), b=(5000, 5200), c=(6000, 6900))
    t = targets(spark, ("a", 0.5, 1), ("b", 0.2, 4), ("c", 0.3, 2), ("none", 0.1, 3))
    for block in (10**9, 500):
        m = mixing.mixed(s, t, block_tokens=block)
        got = {r["source"]: r for r in mixing.shares(m, t).collect()}
        assert abs(got["a"]["actual_share"] - 0.5) < 0.01 and abs(got["b"]["actual_share"] - 0.2) < 0.01 and got["none"]["records"] == 0
        assert all(r["most_uses"] <= r["max_repeats"] for r in got.values())
        assert m.groupBy("doc_id").count().where("count > 1").count() == 0


def test_a_larger_total_heats_the_mixture(spark):
    size, reps, goal = {"a": 1000, "b": 100}, {"a": 1, "b": 2}, {"a": 0.5, "b": 0.5}
    cold, x0, total = mixing.temper(goal, size, reps)
    assert x0 == 0 and total == 400 and cold == {"a": 200.0, "b": 200.0}
    warm, x1, _ = mixing.temper(goal, size, reps, 900)
    assert 0 < x1 < 1 and warm["b"] <= 200.001 and abs(sum(warm.values()) - 900) < 1e-6
    all_, _, most = mixing.temper(goal, size, reps, 10**6)
    assert most == 1200 and all_["a"] == pytest.approx(1000) and all_["b"] == pytest.approx(200)
    assert mixing.temper({}, {}, {}) == ({}, 0.0, 0.0)


def test_sources_by_their_plain_name(spark):
    d = spark.createDataFrame([(1, "Esef ", "some words", "x"), (2, "ESEF", "", "x"), (3, None, "words", "x"), (4, "esef", None, "x"), (1, "Esef ", "some words", "x")], "doc_id bigint, source string, text string, n_tokens string")
    assert [(r["doc_id"], r["source"], r["n_tokens"]) for r in mixing.sized(d).collect()] == [(1, "esef", 2)]
    t = targets(spark, ("esef", 1.0, 1))
    assert mixing.mixed(mixing.sized(d.limit(0)), t).count() == 0


def shares_by_sql(spark, chosen):
    """Actual share, most uses and limits by source, from p8_counts, the documents and the chosen records alone, in DuckDB."""
    import duckdb

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    counts = queries.p8_counts(spark, d).toPandas()  # noqa: F841
    mix = chosen.toPandas()  # noqa: F841
    return con.sql(f"""WITH x AS (SELECT lower(trim(d.source)) AS source, c.n_tokens, m.uses FROM mix m JOIN counts c USING (doc_id) JOIN '{d}/documents.parquet' d USING (doc_id))
      SELECT t.source, t.target_share, t.max_repeats, coalesce(sum(n_tokens * uses), 0) / (SELECT sum(n_tokens * uses) FROM x) AS share, max(uses) AS most, sum(n_tokens * uses) AS used
      FROM '{d}/mix_targets.parquet' t LEFT JOIN x USING (source) GROUP BY ALL""").fetchall()


def test_shares_of_the_documents_by_sql(spark):
    d = "/root/testdata/sf0.01"
    mine = queries.p9_mix(spark, d)
    got = shares_by_sql(spark, mine)
    there = sum(t for _, t, _, share, _, _ in got if share)
    assert all(abs(share - t / there) < 0.01 and most <= cap for _, t, cap, share, most, _ in got if share)
    reported = {r["source"]: r["actual_share"] for r in mixing.shares(mine, spark.read.parquet(f"{d}/mix_targets.parquet")).collect()}
    assert all(reported[s] == pytest.approx(share) for s, _, _, share, _, _ in got)


def test_the_heated_mixture_gives_the_asked_total_within_the_caps(spark):
    d = "/root/testdata/sf0.01"
    plan = queries.p9_heated_plan(spark, d).collect()
    x = plan[0]["exponent"]
    assert 0 < x < 1 and all(r["budget"] <= r["tokens"] * r["max_repeats"] + 1 for r in plan)
    got = {s: (share, most, cap, used) for s, _, cap, share, most, used in shares_by_sql(spark, queries.p9_heated(spark, d))}
    total = sum(r["tokens"] for r in plan)
    assert abs(sum(u or 0 for *_, u in got.values()) / total - 1) < 0.02 and all(m is None or m <= c for _, m, c, _ in got.values())
    # The exponent is the least one: some source stands at its limit, and budgets are those of targets to 1 - x and natural shares to x.
    assert max(r["budget"] / (r["tokens"] * r["max_repeats"]) for r in plan if r["tokens"]) == pytest.approx(1, abs=1e-6)
    raw = {r["source"]: r["target_share"] ** (1 - x) * (r["tokens"] / total) ** x for r in plan if r["tokens"]}
    assert all(r["budget"] == pytest.approx(total * raw[r["source"]] / sum(raw.values()), rel=1e-6) for r in plan if r["tokens"])


# Personal information


def test_nothing_of_the_labelled_table_stands_in_the_documents():
    import duckdb

    said = "\n".join(t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' WHERE text IS NOT NULL").fetchall())
    words = set(re.findall(r"[^\W\d_]+", said))
    listed = [x for table in (pii_table.SURNAMES, pii_table.GIVEN) for xs in table.values() for x in xs if len(x) > 1]
    assert [x for x in listed if (x in words if x.isascii() else x in said)] == []
    made = {text[a:b] for text, spans in pii_table.labelled() for a, b, k in spans if k in ("name", "address", "email") and b - a > 3}
    assert [x for x in made if x in said] == [] and len(made) > 3000


def test_held_out_lines_with_other_words():
    field, right, said, there = pii.trained(), 0, 0, 0
    for text, spans in pii_table.labelled(500, 4321):
        got = {(a, b, k) for a, b, k in pii.finds(field, [text])[0]}
        want = {(a, b, k) for a, b, k in spans}
        right, said, there = right + len(got & want), said + len(got), there + len(want)
    assert right / said > 0.9 and right / there > 0.9


def best_path(field, em):
    """Viterbi in plain loops over one segment's emissions."""
    score, back = [float(e + s) for e, s in zip(em[0], pii.START, strict=True)], []
    for row in em[1:]:
        step = [max((score[a] + float(field.moves[a][b]), -a) for a in range(pii.K)) for b in range(pii.K)]
        back.append([-a for _, a in step])
        score = [x + float(e) for (x, _), e in zip(step, row, strict=True)]
    path = [max(range(pii.K), key=lambda k: score[k])]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_decoding_is_the_best_path_whatever_the_length(monkeypatch):
    field, text = pii.trained(), pii.folded(" ".join(t.replace("\n", " ") for t, _ in pii_table.labelled(150, 5)))
    toks = [m.span() for m in pii.TOKEN.finditer(text)]
    em = field.emissions([(text, toks), ("a b", [(0, 1), (2, 3)])])
    assert len(toks) > 2000 and field.decode(em)[0].tolist() == best_path(field, em[0])
    monkeypatch.setattr(pii, "TOGETHER", 777)
    again = field.emissions([(text, toks), ("a b", [(0, 1), (2, 3)])])
    assert all((a == b).all() for a, b in zip(em, again, strict=True))


def test_finds_are_replaced_and_the_rest_stays():
    field = pii.trained()
    t = "Contact: jessamy.quenby@larkmere.example Telephone 020 7946 0335. Quenby Group plc holds 5% of the votes."
    got = pii.finds(field, [t, None, "", "  "])
    assert {k for _, _, k in got[0]} == {"email", "phone"} and got[1:] == [[], [], []]
    assert pii.replaced(t, got[0]) == "Contact: [EMAIL] Telephone [PHONE]. Quenby Group plc holds 5% of the votes."
    assert pii.replaced(None, []) is None


def test_long_segments_are_read_whole():
    field = pii.trained()
    t = "word " * 3000 + "Telephone 020 7946 0335"
    assert [k for _, _, k in pii.finds(field, [t])[0]] == ["phone"]


def test_found_rows(spark):
    d = spark.createDataFrame([(1, "電話番号は03-1234-5678である。電話番号は03-1234-5679である。", 1), (2, None, 1), (3, "", 1), (1, "電話番号は03-1234-5678である。", 1)], "doc_id bigint, text string, pii_type int")
    assert [tuple(r) for r in pii.found(d).collect()] == [(1, "phone")]
    assert pii.masked(d).count() == 4 and pii.found(d.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run_on_the_smallest_tables(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
