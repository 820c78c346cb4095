import csv
import gzip
import hashlib
import json
from pathlib import Path

import pytest

from claimworks.schema import CLAIMS
from claimworks.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, **{"spark.sql.shuffle.partitions": "8"})


def claim(**overrides):
    """One sound raw row of the table's own columns, all text: codes by place, amounts that agree."""
    codes = {c: str(20 + i) for i, c in enumerate(CLAIMS.codes)}
    amounts = {c: "7.35" if c.endswith("REM_MNT") else "1" for c in CLAIMS.numeric}
    known = {CLAIMS.month: "202503", "PRS_NAT": "0342", "PRS_REM_TYP": "1", "SOI_MOI": "11"}
    return codes | amounts | known | overrides


def put_text(root, lines, month="202503", name=None, sidecar=None):
    """Write raw text as an archive with its sidecar."""
    folder = Path(root) / "data/raw"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / (name or f"A{month}.csv.gz")
    path.write_bytes(gzip.compress("".join(f"{line}\n" for line in lines).encode()))
    seal(path, sidecar)
    return path


def seal(path, sidecar=None):
    declared = {"sha256": hashlib.sha256(path.read_bytes()).hexdigest()}
    Path(f"{path}.json").write_text(json.dumps(declared | (sidecar or {})))


def put_archive(root, rows, month="202503", header=None):
    """Write rows as an archive with the trailing separator."""
    header = list(header or rows[0])
    lines = [";".join([*header, ""])]
    lines += [";".join([*(row.get(c, "") for c in header), ""]) for row in rows]
    return put_text(root, lines, month)


def put_labels(root, labels):
    folder = Path(root) / "references"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "modalites.json").write_text(json.dumps(labels), encoding="utf-8")


def read_csv_folder(folder):
    """All rows of a CSV result, parts in order."""
    rows = []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with part.open(encoding="utf-8", newline="") as stream:
            rows += list(csv.DictReader(stream))
    return rows
