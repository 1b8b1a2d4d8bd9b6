import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from test_contain import slow as slow_contained
from test_lines_and_secrets import slow_lines
from test_packing import check_plan
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_a_query():
    names = E.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "packing"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """What every stage returns, each written and read again for the next."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for n, (_, stage) in enumerate(cp.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{folder}/{n}")
        frames.append(spark.read.parquet(f"{folder}/{n}"))
    return frames


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.orderBy("doc_id").collect()]


def test_columns_stay(staged):
    for frame in staged[:-1]:
        assert frame.columns == COLUMNS
    assert all(f.dtypes == staged[0].dtypes for f in staged[1:-1])


def test_language_stage_keeps_clean_documents(staged):
    before, after = dict(rows(staged[0])), dict(rows(staged[1]))
    assert after.items() <= before.items() and len(after) >= 0.98 * len(before)


def test_line_stage(staged):
    want = {i: text for i, _, _, text in slow_lines(rows(staged[1]))}
    assert dict(rows(staged[2])) == want
    assert staged[2].where("n_chars <> length(text)").count() == 0


def test_simhash_stage(staged):
    texts = dict(rows(staged[2]))
    low = slow_components({i: slow_fingerprint(t) for i, t in texts.items()}, 2)
    assert dict(rows(staged[3])) == {i: t for i, t in texts.items() if low[i] == i}


def test_decontamination_stage(staged, spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = rows(staged[3])
    dirty = {d for d, *_ in slow_contained(texts, items)}
    assert rows(staged[4]) == [(i, t) for i, t in texts if i not in dirty] and dirty


def test_packing_stage(staged):
    check_plan(staged[5].collect(), dict(rows(staged[4])), 2048)


def test_run_gives_the_pieces_of_the_same_documents(spark, staged):
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, staged[5].select(*pieces).collect()))
    assert sorted(map(tuple, cp.run(spark, SF).select(*pieces).collect())) == want


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_hard_rows(spark, stage):
    rng = random.Random(1)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    some = [(i, " ".join(rng.choice("the cat and dog is here in of to a".split()) for _ in range(30)), "en", "s", 5) for i in range(20)]
    some += [(30, None, None, None, None), (31, "", "en", "s", 0), (None, "the cat is null", "en", None, 3), (None, "the cat is null", "en", None, 3),
             (3, some[3][1], "en", "s", 5), (40, "the " * 40_000, "en", "s", 1), (41, "12 34", None, "s", None)]
    out = cp.STAGES[stage][1](spark, spark.createDataFrame(some, schema).repartition(2), SF)
    got = out.collect()
    kept = {r["doc_id"] for r in got}
    assert set(range(20)) | {None, 40} <= kept
    if stage == 0:
        assert not kept & {30, 31, 41}
    if stage == 2:
        assert sum(r["doc_id"] == 3 for r in got) == 1 and kept & {30, 31} == {30}
    if stage < 4:
        assert out.columns == COLUMNS
    assert cp.STAGES[stage][1](spark, spark.createDataFrame([], schema), SF).collect() == []


def test_reads_the_checkpoint_folder_of_the_session(spark):
    from tillbook.llm.common import cut
    cut(spark.range(3).select(F.col("id")))
    assert spark.sparkContext.getCheckpointDir().startswith(f"file:{spark.conf.get('spark.checkpoint.dir')}")


NAMES = ["score", "n_lines", "rejected", "lang_pred", "n_dropped", "__kept", "__hash", "__lines", "__row", "__text_hash", "N_Dropped2"]


def test_own_columns_stay_in_every_stage(spark, table):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    docs = base.select("*", *(F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in NAMES))
    for _, stage in cp.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert got.where(" OR ".join(f"`{n}` <> concat('{n}-', doc_id)" for n in NAMES)).count() == 0 and got.count() > 100


def test_rows_of_one_id_are_not_lost(spark, table):
    one, two = " ".join(f"alpha{i}" for i in range(50)), " ".join(f"omega{i}" for i in range(50))
    rows = [(1, one, "en", "b", 1), (1, two, "en", "a", 1), (1, one, "en", "a", 1), (2, two, "en", "a", 1), (None, one, "en", "a", 1), (None, one, "en", "a", 1),
            (3, None, "en", "a", 1), (4, "", "en", "a", 1)]
    docs = table(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, cp.near_dedup(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(1, one, "en", "a", 1), (1, two, "en", "a", 1), (None, one, "en", "a", 1), (None, one, "en", "a", 1), (3, None, "en", "a", 1)], key=repr)


def test_stages_on_an_empty_table(spark, table):
    docs = table([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_the_library_works_without_tokenizers(tmp_path):
    import subprocess
    import sys
    (tmp_path / "tiktoken.py").write_text("raise ModuleNotFoundError('gone', name='tiktoken')")
    code = "import __spark_entry__ as e; print(len(e.queries()) > 100, any(n.startswith('op') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=cp.__file__.rsplit("/", 1)[0], capture_output=True, text=True,
                          env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})
    assert done.stdout.split() == ["True", "False"], done.stderr
