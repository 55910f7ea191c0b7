"""A numbered log of which folders make up a table that a stream keeps adding to.

Every commit is one small file that names all live folders, so a reader sees the table before a change or after it. Folders that
a commit replaced stay for some further commits, for readers that planned with the older one, and are then removed. The log
keeps as many commits, so neither it nor the table's folder grows with the number of micro-batches.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from convoy.sources import files

LOG = "_log"
#: Commits for which a replaced folder stays.
RETAIN = 20


class CommitConflict(Exception):
    """Another writer committed first; the table is as that writer left it."""


def newest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The number and content of the newest commit, 0 and nothing if there is none."""
    names = files.names(spark, f"{root}/{LOG}")
    done = [name for name in names if name.isdigit()]
    return (int(done[-1]), json.loads(files.read_text(spark, f"{root}/{LOG}/{done[-1]}"))) if done else (0, {})


def commit(spark: SparkSession, root: str, after: int, state: dict, dropped: list[str] = (), retain: int = RETAIN) -> int:
    """Make ``state`` the content that is read, if ``after`` is still the newest commit.

    Its ``folders`` are the live ones, below root; ``dropped`` names those that it no longer needs.
    """
    number = after + 1
    retired = [*state.get("retired", []), *([folder, number] for folder in dropped)]
    gone = [folder for folder, since in retired if since <= number - retain]
    for folder in gone:  # before the commit that forgets them; removing one again does no harm
        files.drop(spark, f"{root}/{folder}")
    state = {**state, "retired": [entry for entry in retired if entry[0] not in gone]}
    draft, target = f"{root}/{LOG}/draft-{number}", f"{root}/{LOG}/{number:012d}"
    files.drop(spark, draft)
    files.write_text(spark, draft, json.dumps(state))
    if files.exists(spark, target):
        raise CommitConflict(f"commit {number} of {root} is taken")
    files.move(spark, draft, target)
    for name in files.names(spark, f"{root}/{LOG}"):
        if name.isdigit() and int(name) <= number - retain:
            files.drop(spark, f"{root}/{LOG}/{name}")
    return number


def sweep(spark: SparkSession, root: str, below: str = "") -> list[str]:
    """Remove the folders below root that the newest commit neither names nor keeps for readers: what it has let go of in whole,
    and what a writer left that died before its commit.

    Only the one writer of a table may call it, between two commits.
    """
    _, state = newest(spark, root)
    known = [*state.get("folders", []), *(folder for folder, _ in state.get("retired", []))]
    present = [f"{below}/{name}".strip("/") for name in files.names(spark, f"{root}/{below}") if not name.startswith("_")]
    orphans = [here for here in present if not any(f"{folder}/".startswith(f"{here}/") for folder in known)]
    for folder in orphans:
        files.drop(spark, f"{root}/{folder}")
    return orphans
