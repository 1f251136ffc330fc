from __future__ import annotations

import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session

    session = local_session(cores="*", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the shared checkpoint root."""
    from sluice.session import ensure_checkpoint_dir

    # Letters only: date regexes match on the full path, so no digits may sneak in.
    name = uuid.uuid4().hex[:12].translate(str.maketrans("0123456789", "ghijklmnop"))
    path = f"{ensure_checkpoint_dir(spark)}/sluice-tests/{name}"
    os.makedirs(path.removeprefix("file:"), exist_ok=True)
    return path.removeprefix("file:")


def rows(df, *cols):
    """Collect selected columns as plain tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
