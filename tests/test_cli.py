"""Configuration files and the command line, over a source that is a folder of responses."""

import json
import os

import pytest

from pagelake.__main__ import main
from pagelake.plans.config import discover_sources, load_run_config, load_source_config
from pagelake.plans.registry import SourceSpec, select_datasets, source_spec

EXAMPLES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples")


@pytest.mark.parametrize("load, path", [
    (lambda root: load_run_config(f"{root}/absent.yaml"), "absent.yaml"),
    (lambda root: load_source_config(str(root), "nobody"), "nobody/config.yaml"),
])
def test_an_absent_file_is_named(tmp_path, load, path):
    with pytest.raises(FileNotFoundError) as failure:
        load(tmp_path)
    assert path in str(failure.value)


def test_documents_that_are_no_mapping(tmp_path):
    (tmp_path / "list.yaml").write_text("- 1\n- 2\n")
    with pytest.raises(ValueError, match="mapping"):
        load_run_config(str(tmp_path / "list.yaml"))
    (tmp_path / "empty.yaml").write_text("# nothing yet\n")
    assert load_run_config(str(tmp_path / "empty.yaml")) == {}
    assert select_datasets([], load_run_config(str(tmp_path / "empty.yaml"))) == []


def test_shipped_example_with_defaults():
    (source,) = discover_sources(os.path.join(EXAMPLES, "datasets"))
    assert [(d.name, d.endpoint, dict(d.params), d.paging.enabled) for d in source.datasets] == [
        ("events", "events/export", {"order": "time"}, True), ("users", "users", {}, False)]
    assert (source.key_env, source.retries, source.first_wave, source.max_wave) == ("CLICKS_KEY", 2, 8, 256)
    chosen = select_datasets([source], load_run_config(os.path.join(EXAMPLES, "config.yaml")))
    assert [d.qualified_name for s in chosen for d in s.datasets] == ["clicks.events"]


def test_header_groups():
    doc = {"name": "s", "variables": {"base_url": "https://h"}, "headers": {"a": {"k": "1"}, "b": {"k": 2}}}
    assert source_spec(doc, headers_group="b").headers == {"k": "2"}
    assert source_spec(doc | {"headers": {"only": {"k": "v"}}}).headers == {"k": "v"}
    with pytest.raises(ValueError, match="several header groups"):
        source_spec(doc)
    with pytest.raises(ValueError, match="no request headers in group c"):
        source_spec(doc, headers_group="c")
    with pytest.raises(ValueError, match="needs request headers"):
        source_spec(doc | {"headers": {}})
    with pytest.raises(ValueError, match="holds a group"):
        SourceSpec("s", headers={"a": {"k": "1"}})
    assert source_spec({"name": "s", "variables": {"base_url": "/folder"}}).headers == {}


def write_source(root, responses):
    folder = root / "datasets" / "feed"
    (folder / "schema").mkdir(parents=True)
    (folder / "config.yaml").write_text(f"name: feed\nvariables: {{base_url: {root}/answers, first_wave: 2}}\n"
                                        "datasets: {items: {endpoint: v1/items}}\n")
    (folder / "schema" / "items.yaml").write_text("responsePath: items\npagination: {enabled: true}\n"
                                                  "columns: [{name: id, type: integer}, {name: price, type: decimal}]\n")
    (root / "run.yaml").write_text("sources: {feed: {enabled: true, datasets: {items: {enabled: true}}}}\n")
    answers = root / "answers" / "v1" / "items"
    answers.mkdir(parents=True)
    for page, records in responses.items():
        (answers / f"page-{page}.json").write_text(json.dumps({"items": records}))
    return ["--action", "ingest", "--config", str(root / "run.yaml"), "--datasets-dir", str(root / "datasets"),
            "--layer", "cli_t"]


def test_command_line_with_defaults(spark, tmp_path):
    args = write_source(tmp_path, {p: [{"id": 10 * p + k, "price": 0.5} for k in range(3)] for p in range(1, 6)})
    assert main([*args, "--dataset", "*"]) == 0
    rows = spark.table("cli_t.feed_items").orderBy("id").collect()
    assert [r.id for r in rows] == [10 * p + k for p in range(1, 6) for k in range(3)]
    assert {r.price for r in rows} == {"0.5"}  # an unknown type word is text
    assert main([*args, "--dataset", "feed.unknown"]) == 0  # nothing selected: a warning
    with pytest.raises(SystemExit):
        main([*args, "--dataset", "*", "--action", "other"])
