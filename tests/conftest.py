import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidegate.session import build_session, new_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidegate-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return lambda label="test": new_folder(spark, label)


@pytest.fixture
def write_file(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        lines = content if isinstance(content, str) else "\n".join(json.dumps(line) for line in content)
        path.write_text(lines, encoding="utf-8")
        return str(path)

    write.folder = str(tmp_path)
    return write


def rows(df):
    """Rows as dictionaries, in an order that does not depend on the plan."""
    return sorted((row.asDict(recursive=True) for row in df.collect()), key=lambda row: json.dumps(row, default=str, sort_keys=True))
