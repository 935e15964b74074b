import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from regiostat.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(work=str(tmp_path_factory.mktemp("work")))
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write a file below the test folder and return its path."""

    def write(name, content, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        if isinstance(content, bytes):
            path.write_bytes(content)
        else:
            text = content if isinstance(content, str) else json.dumps(content, ensure_ascii=False)
            path.write_text(text, encoding=encoding)
        return str(path)

    return write
