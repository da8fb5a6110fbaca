"""Merging as files come, and the command line."""

import json

import pytest

from arborline import __main__ as command
from arborline.config import Settings
from arborline.plans import stream
from arborline.sources import documents


def put(root, name, value):
    (root / name).parent.mkdir(parents=True, exist_ok=True)
    (root / name).write_text(value if isinstance(value, str) else json.dumps(value))


def read(out, name):
    return json.loads((out / "merged" / name).read_text())


def batches(out):
    return sorted(int(p.name.split("=")[1]) for p in (out / "entries").glob("batch=*"))


def test_a_second_run_reads_new_files_only(spark, tmp_path):
    root, out = tmp_path / "in", tmp_path / "out"
    put(root, "Butte/attrs/2018.json", {"a": {"v": 1}, "b": {"v": 1}})
    put(root, "Kern/2018.json", {"b": {"v": 2}})
    put(root, "Kern/2019.json", "{}")
    put(root, "webapp/2018.json", {"no": 1})
    assert stream.follow(spark, str(root), str(out), files_a_batch=2) == 1
    assert read(out, "2018.json") == {"a": {"v": 1}, "b": {"v": 2}}
    first = batches(out)
    rows = stream.entries_of_last_batches(spark, str(out)).count()
    put(root, "Zeta/2018.json", {"b": {"v": 3}, "c": None})
    assert stream.follow(spark, str(root), str(out)) == 1
    assert read(out, "2018.json") == {"a": {"v": 1}, "b": {"v": 3}, "c": None}
    new = [b for b in batches(out) if b not in first]
    assert len(new) == 1 and spark.read.parquet(f"{out}/entries/batch={new[0]}").count() == 2
    assert stream.entries_of_last_batches(spark, str(out)).count() == rows + 2
    stream.follow(spark, str(root), str(out))
    assert [b for b in batches(out) if b not in first] == new


def test_a_crash_between_batches_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", tmp_path / "out"
    for i in range(4):
        put(root, f"f{i}/2018.json", {f"k{i}": {"v": i}, "same": i})
    real, calls = stream.merging.entries, []

    def fails(files):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(files)

    monkeypatch.setattr(stream.merging, "entries", fails)
    with pytest.raises(Exception, match="lost"):
        stream.follow(spark, str(root), str(out), files_a_batch=1)
    assert len(batches(out)) == 2 and not (out / "merged").exists()
    monkeypatch.setattr(stream.merging, "entries", real)
    stream.follow(spark, str(root), str(out), files_a_batch=1)
    assert read(out, "2018.json") == {**{f"k{i}": {"v": i} for i in range(4)}, "same": 3}
    assert stream.entries_of_last_batches(spark, str(out)).count() == 8


def test_flags_are_settings():
    args = command.parser().parse_args(["run", "--winter", "a", "b", "--out", "o"])
    assert command.settings_of(args) == Settings() and args.winter == ["a", "b"]
    args = command.parser().parse_args("run --winter a --out o --min-quality 0.4 --ks 2 4 --no-use-valid-fraction --strata county --index-column q --k-select bic --trend-periods 3 4".split())
    assert command.settings_of(args) == Settings(min_quality=0.4, ks=(2, 4), use_valid_fraction=False, strata=("county",), index_column="q", k_select="bic", trend_periods=(3, 4))
    assert command.main(["run", "--out", "o"]) == 2
    with pytest.raises(SystemExit):
        command.parser().parse_args(["walk"])


def test_merge_by_command(spark, tmp_path, capsys):
    put(tmp_path / "in", "Kern/2018.json", {"a": {"v": 1}})
    assert command.main(["merge", str(tmp_path / "in"), str(tmp_path / "out"), "--whole"], spark) == 0
    assert json.loads(capsys.readouterr().out)["most_orchards"] == 1 and documents.opened("file:/x y")[1] == "/x y"
    assert command.main(["follow", str(tmp_path / "in"), str(tmp_path / "out2")], spark) == 0
    assert read(tmp_path / "out2", "2018.json") == {"a": {"v": 1}}
