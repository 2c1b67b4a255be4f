import base64
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from eventloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


def encode(payload: str) -> str:
    return base64.b64encode(payload.encode()).decode()


def record(data: str, **changes) -> dict:
    return {
        "receivedAt": "2021-03-04T05:06:07.250Z", "clientIp": "198.51.100.26", "uuid": "rec-a",
        "recordversion": 3, "edgeType": "internal", "data": data, **changes,
    }


@pytest.fixture(scope="session")
def lines(spark):
    """Edge-record lines: dicts are encoded, texts are taken as they are."""
    def build(*rows):
        texts = [r if isinstance(r, str) else json.dumps(r) for r in rows]
        return spark.createDataFrame([(t,) for t in texts], "value string")

    return build
