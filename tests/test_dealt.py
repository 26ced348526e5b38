"""Work on small files that hold much is dealt over tasks."""

from __future__ import annotations

from pathlib import Path

from workloads import files, records

SF = "/root/testdata/sf0.001"


def test_definitions_are_checked_by_many_tasks(spark):
    assert records.format_definition_errors(spark, SF).rdd.getNumPartitions() > 1


def test_order_lines_are_not_written_by_one_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "new_work_dir", lambda *_: f"{tmp_path}/csv")
    monkeypatch.setattr(files, "_line_items", lambda s, d, made=files._line_items: made(s, d).repartition(3))
    files.csv_split_docs(spark, SF)
    assert len(list(Path(f"{tmp_path}/csv/lines").glob("part-*"))) > 1
