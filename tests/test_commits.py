import threading

from tidemark.sources import commits
from tidemark.sources.shared import fresh_path


def test_files_are_whole_and_taken_once(spark):
    path = f"{fresh_path(spark, 'c')}/a.json"
    assert commits.get_json(spark, path) is None
    assert commits.put_json(spark, path, {"x": "ü", "n": [1, None]})
    assert not commits.put_json(spark, path, {"x": 2})
    assert commits.get_json(spark, path) == {"x": "ü", "n": [1, None]}
    assert commits.put_json(spark, path, {"x": 3}, replace=True)
    assert commits.get_json(spark, path) == {"x": 3}
    folder = path.rsplit("/", 1)[0]
    assert [n for n, _ in commits.children(spark, folder) if n.startswith("_aside")] == []
    commits.delete(spark, folder)
    assert commits.children(spark, folder) == [] and commits.size_of(spark, folder) == (0, 0)


def test_one_writer_gets_each_entry(spark):
    log = fresh_path(spark, "log")
    won = []

    def write(name):
        for number in range(1, 6):
            if commits.append(spark, log, number, {"by": name}):
                won.append((number, name))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in won) == [1, 2, 3, 4, 5]
    assert [(n, e["by"]) for n, e in commits.entries(spark, log)] == sorted(won)
    assert [n for n, _ in commits.entries(spark, log, after=3)] == [4, 5]
