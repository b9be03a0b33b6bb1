import datetime
import glob
import os
import tempfile

import pytest

from ratewise.sources import reviews as R
from ratewise.sources import tables as S

BLOCK = [
    "<Author>alice", "<Product>P1", "<Date>3 7, 2005", "<Summary>Short title",
    "<Content>  One line of café. ", "<Helpful>3/4", "<Rating>5",
]


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def block(**changes):
    lines = list(BLOCK)
    for key, value in changes.items():
        index = ["author", "product", "date", "summary", "content", "helpful", "rating"].index(key)
        lines[index] = value
    return "\n".join(lines)


def train(spark, text, **kw):
    folder = tempfile.mkdtemp(prefix="ratewise-test-")
    write(folder, "f.txt", text)
    return R.load_train(spark, folder, **kw)


def test_two_reviews_in_one_file(spark):
    rows = train(spark, block() + "\n\n" + block(author="<Author>bob", rating="<Rating>1") + "\n").collect()
    assert sorted(r.author for r in rows) == ["alice", "bob"]
    alice = next(r for r in rows if r.author == "alice")
    assert alice.content == "  One line of café."
    assert alice.date == datetime.date(2005, 3, 7) and alice.date_raw == "3 7, 2005"
    assert tuple(alice.helpful) == (3, 4) and alice.rating == 5 and alice.id == -1
    assert alice.split == "train"


def test_crlf_no_final_newline_and_any_separator(spark):
    text = (block() + "\nanything\n" + block()).replace("\n", "\r\n")
    assert [r.product for r in train(spark, text).collect()] == ["P1", "P1"]


def test_small_splits_give_the_same_rows(spark, folder):
    write(folder, "f.txt", "\n\n".join(block(author=f"<Author>a{i}") for i in range(200)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        frame = R.load_train(spark, folder)
        assert frame.rdd.getNumPartitions() > 4
        assert {(r.id, r.author) for r in frame.collect()} == {(-1 - i, f"a{i}") for i in range(200)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(
    "text",
    [
        block() + "\n\n",
        "",
        block() + "\n" + block(),
        block() + "\n" + block() + "\n\n",
        block(product="P1"),
        block(author="alice without tag"),
        "\n" + block(),
        block(product=" <Product>P1"),
        block(helpful="<Helpful>5/4"),
        block(helpful="<Helpful>3"),
        block(helpful="<Helpful>1/2/3"),
        block(rating="<Rating>x"),
    ],
)
def test_malformed_train_files(spark, text):
    with pytest.raises(Exception):
        train(spark, text).collect()


def test_permissive_keeps_bad_rows(spark):
    frame = train(spark, block() + "\n\n" + block(rating="<Rating>x"), mode=R.PERMISSIVE)
    rows = sorted(frame.collect(), key=lambda r: r._corrupt_reason or "")
    assert rows[0]._corrupt_record is None and rows[0].rating == 5
    assert rows[1].rating is None and "rating" in rows[1]._corrupt_reason


def test_count_alone_still_checks(spark):
    with pytest.raises(Exception):
        train(spark, block(rating="<Rating>x")).count()


TEST_TEXT = "\n".join(BLOCK[:5]) + "\n"


def test_load_test(spark, folder):
    for i in (1, 2, 3):
        write(folder, f"{i}.txt", TEST_TEXT)
    rows = R.load_test(spark, folder).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3]
    assert rows[0].rating is None and rows[0].helpful is None and rows[0].split == "test"


@pytest.mark.parametrize(
    "files",
    [
        {"1.txt": TEST_TEXT, "3.txt": TEST_TEXT},
        {"a1b2.txt": TEST_TEXT},
        {"a.txt": TEST_TEXT},
        {"1.txt": "\n".join(BLOCK[:4])},
        {"1.txt": "\n".join(BLOCK[:6])},
    ],
)
def test_malformed_test_files(spark, folder, files):
    for name, text in files.items():
        write(folder, name, text)
    with pytest.raises(Exception):
        R.load_test(spark, folder).collect()


def test_dataset_cache(spark, folder):
    train_dir, test_dir = tempfile.mkdtemp(), tempfile.mkdtemp()
    write(train_dir, "f.txt", block())
    write(test_dir, "1.txt", TEST_TEXT)
    path = folder + "/data"
    S.create_dataset(spark, train_dir, test_dir, path)
    assert S.load_dataset(spark, path).count() == 2
    write(train_dir, "g.txt", block())
    S.create_dataset(spark, train_dir, test_dir, path, overwrite_old=False)
    assert S.load_dataset(spark, path, "train").count() == 1
    S.create_dataset(spark, train_dir, test_dir, path)
    assert S.load_dataset(spark, path, "train").count() == 2


def test_a_cut_off_dataset_is_none(spark, folder, monkeypatch):
    train_dir, test_dir, path = tempfile.mkdtemp(), tempfile.mkdtemp(), folder + "/data"
    write(train_dir, "f.txt", block())
    write(test_dir, "1.txt", TEST_TEXT)
    with pytest.raises(FileNotFoundError):
        S.load_dataset(spark, path)

    class CutOff(Exception):
        pass

    def cut(*_):
        raise CutOff

    # The writer dies with all rows written and nothing published.
    with monkeypatch.context() as patch:
        patch.setattr(S, "_publish", cut)
        with pytest.raises(CutOff):
            S.create_dataset(spark, train_dir, test_dir, path)
    assert S.dataset_manifest(spark, path) is None
    with pytest.raises(FileNotFoundError):
        S.load_dataset(spark, path)
    S.create_dataset(spark, train_dir, test_dir, path, overwrite_old=False)  # what is there is not kept: it is no dataset
    first = S.dataset_manifest(spark, path)
    assert first["rows"] == {"train": 1, "test": 1} and len(glob.glob(path + "/version-*")) == 1

    # A later writer dies: readers still see the version before.
    write(train_dir, "g.txt", block())
    with monkeypatch.context() as patch:
        patch.setattr(S, "_publish", cut)
        with pytest.raises(CutOff):
            S.create_dataset(spark, train_dir, test_dir, path)
    assert S.dataset_manifest(spark, path) == first and S.load_dataset(spark, path, "train").count() == 1
    S.create_dataset(spark, train_dir, test_dir, path)
    assert S.load_dataset(spark, path, "train").count() == 2 and len(glob.glob(path + "/version-*")) == 1


def test_other_tables_are_no_dataset(spark, folder):
    spark.range(3).write.parquet(folder + "/data")
    assert S.dataset_manifest(spark, folder + "/data") is None


def test_submission_parts_join_to_the_file(spark, folder):
    predictions = spark.createDataFrame([(i, i / 7) for i in range(1, 400)], "id long, prediction double").repartition(9)
    S.write_submission_parts(predictions, folder + "/parts")
    S.write_submission(predictions, folder + "/one", single_file=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.write_submission_parts(predictions, folder + "/many")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    joined = lambda name: b"".join(open(p, "rb").read() for p in sorted(glob.glob(f"{folder}/{name}/part-*")))
    assert len(glob.glob(folder + "/many/part-*")) > 1
    assert joined("parts") == joined("many") == joined("one")
    S.write_submission_parts(predictions.limit(0), folder + "/none")
    assert joined("none") == b"id,rating\r\n"


def test_submission_file(spark, folder):
    predictions = spark.createDataFrame([(2, 2.5), (1, 0.1)], "id long, prediction double")
    S.write_submission(predictions, folder + "/out", single_file=True)
    (part,) = glob.glob(folder + "/out/part-*.csv")
    with open(part, "rb") as f:
        assert f.read() == b"id,rating\r\n1,0.100000000000000006\r\n2,2.500000000000000000\r\n"


def test_prediction_store(spark, folder):
    predictions = spark.createDataFrame([(1, 3.0)], "id long, prediction double")
    S.append_predictions(predictions, folder + "/p", "zero")
    S.append_predictions(predictions, folder + "/p", "mean")
    assert {r.model for r in S.load_predictions(spark, folder + "/p").collect()} == {"zero", "mean"}


def test_from_files_to_splits_every_row_counts(spark, folder):
    from ratewise.operators import evaluation as E
    from ratewise.plans.features import content_stages
    from pyspark.ml import Pipeline

    for f in range(3):
        write(folder, f"{f}.txt", "\n\n".join(block(content=f"<Content>text {f} number {i % 7}", rating=f"<Rating>{1 + i % 5}") for i in range(20)) + "\n")
    reviews = R.load_train(spark, folder)
    assert sorted(r.id for r in reviews.collect()) == list(range(-60, 0))
    train, validate = E.holdout(reviews, 0.3)
    assert train.count() + validate.count() == 60 and validate.count() > 0
    features = Pipeline(stages=content_stages(1, min_df=0.01)).fit(reviews).transform(reviews)
    assert features.count() == 60
    folds = E.stratified_folds(features.select("id", "rating", "features"), "rating", 3).groupBy("rating", "fold").count().collect()
    assert sorted(r["count"] for r in folds) == [4] * 15
    batches = E.numbered_batches(reviews.select("id"), n_batches=7).groupBy("batch_no").count().collect()
    assert sorted(r["count"] for r in batches) == [8, 8, 8, 9, 9, 9, 9]
    with pytest.raises(Exception, match="row without id"):
        E.holdout(spark.createDataFrame([(None,)], "id long"))[0].collect()
