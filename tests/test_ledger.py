"""A run that dies goes on where it stopped; hashes depend on content only."""

import pytest

from plumbline.operators.ledger import StageLedger, folder_hash, tree_hash


def test_a_failed_run_goes_on(spark, tmp_path):
    made = []

    def build(n, fail=False):
        made.append(n)
        if fail:
            raise RuntimeError("lost")
        return spark.range(n)

    def run(fail):
        book = StageLedger(spark, f"{tmp_path}/book")
        a = book.stage("scan", ["x"], lambda: build(3), size=3)
        b = book.stage("fit", [book.key("scan", ["x"], size=3)], lambda: build(5, fail))
        return a.count(), b.count(), book

    with pytest.raises(RuntimeError):
        run(True)
    state = {r.stage: (r.status, r.message) for r in StageLedger(spark, f"{tmp_path}/book").latest().collect()}
    assert state == {"scan": ("completed", None), "fit": ("failed", "lost")}
    (tmp_path / "book/events/half").mkdir()  # an event that was being written
    assert run(False)[:2] == (3, 5) and made == [3, 5, 5]
    assert run(False)[:2] == (3, 5) and made == [3, 5, 5]
    book = StageLedger(spark, f"{tmp_path}/book")
    assert book.stage("scan", ["y"], lambda: build(4), size=3).count() == 4 and made[-1] == 4  # other input, other key


def test_hashes_of_content(spark, tmp_path):
    rows = [("g", i, f"d{i % 7}") for i in range(600)]
    one = tree_hash(spark.createDataFrame(rows, "g string, name int, digest string").repartition(5), ["g"], "name", "digest").first()
    two = tree_hash(spark.createDataFrame(rows[::-1], "g string, name int, digest string"), ["g"], "name", "digest").first()
    other = tree_hash(spark.createDataFrame([*rows[:-1], ("g", 599, "new")], "g string, name int, digest string"), ["g"], "name", "digest").first()
    assert one == two and one.n == 600 and other.root != one.root
    for d, text in (("a", "1"), ("b", "1"), ("c", "2")):
        (tmp_path / d / "sub").mkdir(parents=True)
        (tmp_path / d / "sub/f.txt").write_text(text)
    a, b, c = (folder_hash(spark, f"{tmp_path}/{d}") for d in "abc")
    assert a == b != c
