"""The corpus pipeline stage by stage against brute force, and the SQL of the queries that have one."""

import random
import re

import duckdb
import pytest

import corpus_pipeline
from mastline.llm import queries, simhash
from tests.llm.test_operators import grouped_by, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC, COPIES, NEAR, LEAKED = range(1000, 1010), range(1100, 1110), range(1200, 1210), range(1300, 1306)


@pytest.fixture
def folder(spark, docs, tmp_path):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = prose(60, 9000 + i).split()
        for _ in range(4 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "awful"]))
        rows.append([i, " ".join(words)])
        labels.append((i, 1, int(bad)))
    clean = {i: t for i, t in rows if i % 5}
    passages = [prose(30, 500 + k) for k in range(len(LEAKED))]
    rows += [[i, " ".join(["vile", "nasty", "awful", *prose(40, i).split(), "nasty", "vile"])] for i in TOXIC]
    rows += [[i, clean[5 * k + 1].replace(" ", "\n") + " "] for k, i in enumerate(COPIES)]
    rows += [[i, clean[5 * k + 2].upper()] for k, i in enumerate(NEAR)]
    rows += [[i, f"{prose(20, i)} {p.upper()} {prose(20, i + 50)}"] for i, p in zip(LEAKED, passages, strict=True)]
    rows += [[1400, ""], [1401, None]]
    path = str(tmp_path / "tables")
    docs([(*r, "en", f"s{r[0] % 4}") for r in rows]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    vectors = [(i, [rng.gauss(0, 0.1) for _ in range(16)], rng.randrange(10)) for i in range(700)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def kept_of_groups(groups, best):
    return {min(g, key=best) for g in groups}


def copies_gone(found):
    groups = {}
    for i, t in found.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append(i)
    return kept_of_groups(groups.values(), lambda i: (-len(found[i]), i))


def near_gone(found):
    fp = {i: int.from_bytes(simhash.fingerprint(t), "big") for i, t in found.items()}
    return {g for (g,) in grouped_by(sorted(fp), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 4).values()}


def test_stages(spark, folder, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    df, steps = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = texts(df)
        stage(spark, df, folder).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        steps.append((before, texts(df)))
        if name != "mixing":
            assert df.columns == COLUMNS
    before, after = steps[0]
    assert not set(TOXIC) & set(after)
    toxic = {i for i in before if i < 600 and i % 5 == 0} | set(TOXIC)
    assert len(set(after) & toxic) <= 3 and len(set(before) - toxic - set(after)) <= 3
    assert set(steps[1][1]) == copies_gone(steps[1][0]) and len(steps[1][0]) - len(steps[1][1]) > len(COPIES)
    assert set(steps[2][1]) == near_gone(steps[2][0]) and not set(NEAR) & set(steps[2][1])
    before, after = steps[3]
    assert set(before) - set(after) == set(LEAKED)
    assert set(steps[4][1]) <= set(steps[4][0]) and all(0 < r.copies <= 3 for r in df.collect())


def test_run_on_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / "none" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_matches_sql(spark, folder, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = queries.QUERIES[name](spark, folder)
    answer = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(answer.columns) == columns
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, answer.project(", ".join(columns)).fetchall()))
