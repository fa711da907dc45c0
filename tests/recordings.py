"""Small invented recordings."""

from __future__ import annotations

import os

from setwise import contract as C

STEP = 0.01


def buttons(text: str) -> list[tuple[int, int, int]]:
    """One letter per sample: . none, t trough, p peak, s start/end, a all, d start and trough."""
    return [
        {".": (0, 0, 0), "t": (1, 0, 0), "p": (0, 1, 0), "s": (0, 0, 1), "a": (1, 1, 1), "d": (1, 0, 1)}[c] for c in text
    ]


def samples(spark, **sessions: str):
    """A frame ``filename, time_vector, trough, peak, start_end_excercise``."""
    rows = [
        (name, round(i * STEP, 2), *pressed)
        for name, text in sessions.items()
        for i, pressed in enumerate(buttons(text))
    ]
    return spark.createDataFrame(rows, "filename string, time_vector double, trough int, peak int, start_end_excercise int")


def by_session(df, *columns: str) -> dict[str, list]:
    found: dict[str, list] = {}
    for row in df.select("filename", "time_vector", *columns).orderBy("filename", "time_vector").collect():
        found.setdefault(row[0], []).append(tuple(row[2:]) if len(columns) > 1 else row[2])
    return found


SQUAT = "..aa..ss..pp....tt....pp....tt..ss.."
DEADLIFT = "..dd..ss..tt....pp....tt....pp..ss.."


def write_recording(folder, name: str, text: str, cells: dict[int, dict[str, str]] | None = None) -> str:
    """A session file; ``cells`` replaces single cells, by row and column."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    lines = [C.HEADER]
    for i, pressed in enumerate(buttons(text)):
        row = {c: f"{(i + 1) * (j + 1):.6f}" for j, c in enumerate(C.RAW)}
        row |= {"timevector": f"{i * STEP:.6f}"} | dict(zip(C.RAW[-3:], map(str, pressed)))
        # A channel that tells lifting from lowering, for the models.
        row["ax1"] = f"{100 + 10 * pressed[0] - 10 * pressed[1] + i % 3:.6f}"
        row |= (cells or {}).get(i, {})
        lines.append(",".join(row[c] for c in C.RAW))
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    return path
