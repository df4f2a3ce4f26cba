import datetime as dt
import gzip
import json
from pathlib import Path

import pytest

from tidelake.session import build_session, configure
from tidelake.sources.lake import Lake

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def _session(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def spark(_session):
    return configure(_session)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


class RawFiles:
    """Writes hourly gzip files of JSON lines."""

    def __init__(self, folder: Path):
        self.folder = folder
        folder.mkdir(parents=True, exist_ok=True)

    def write(self, stamp: str, lines: list, suffix: str = ".json.gz") -> None:
        text = "".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)
        path = self.folder / f"{stamp}{suffix}"
        if suffix.endswith(".gz"):
            with gzip.open(path, "wt", encoding="utf-8") as out:
                out.write(text)
        else:
            path.write_text(text, encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    return RawFiles(tmp_path / "raw")


def event(id, created_at="2024-03-05T10:15:30Z", type="PushEvent", login="ann", repo="acme/one", **more):
    body = {
        "id": id,
        "type": type,
        "created_at": created_at,
        "actor": {"id": 1, "login": login},
        "repo": repo if isinstance(repo, dict) else {"id": 7, "name": repo},
        "payload": {},
    }
    body.update(more)
    return body


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
