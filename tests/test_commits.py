import threading
from datetime import datetime

from docflow import schemas
from docflow.sources.manifests import ManifestStore

DAY = datetime(2023, 11, 20, 6)


def entries(spark, names):
    return spark.createDataFrame(
        [(n, f"https://mirror.example/{n}", 100 + i, f"c{i}", "Mon", DAY, f"/store/{n}") for i, n in enumerate(names)],
        schemas.MANIFEST)


def test_two_writers_with_the_same_number(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "m"))
    store.append(entries(spark, ["base.pdf"]), "r0")
    stale, _ = store.commits()
    # both chose number 1 from the same commits; the second finds it taken and takes 2
    store._write(entries(spark, ["one.pdf"]), "r1", "delta", stale)
    store._write(entries(spark, ["two.pdf"]), "r2", "delta", stale)
    commits, _ = store.commits()
    assert [(c.run_id, c.seq) for c in commits] == [("r0", 0), ("r1", 1), ("r2", 2)]
    assert sorted(r.filename for r in store.read().collect()) == ["base.pdf", "one.pdf", "two.pdf"]
    assert sorted(p.name for p in (tmp_path / "m" / "runs").iterdir()) == ["0-r0", "1-r1", "2-r2"]


def test_concurrent_writers_lose_nothing(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "m"))
    errors = []

    def write(i):
        try:
            ManifestStore(spark, store.path).append(entries(spark, [f"w{i}-a.pdf", f"w{i}-b.pdf"]), f"writer-{i}")
        except Exception as e:  # pragma: no cover - reported below
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    commits, _ = store.commits()
    assert sorted(c.seq for c in commits) == [0, 1, 2, 3]
    assert len({c.run_id for c in commits}) == 4
    assert store.read().count() == 8
    store.append(entries(spark, ["late.pdf"]), "writer-0")  # a committed run again: left alone
    assert store.read().count() == 8
