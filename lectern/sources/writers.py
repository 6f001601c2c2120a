"""Writers for the corpus files.

Ordered single files are what these formats ask for, so their writers sort and
write one partition; tables that only go on to other jobs should stay Parquet.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import maps


def _ordered(df: DataFrame, order: list[str], line: Column) -> DataFrame:
    return df.orderBy(*order).select(line.alias("value")).coalesce(1)


def pipe_metadata(df: DataFrame, path: str, order: str, columns: tuple[str, ...] = ("wav", "text"), overwrite: bool = False) -> None:
    """Unquoted bar-delimited lines."""
    _ordered(df, [order], F.concat_ws("|", *columns)).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def jsonl(df: DataFrame, path: str, order: str, raw: str | None = None, overwrite: bool = False) -> None:
    """One object per line without the columns that start with an underscore; ``raw`` is written as it is where not null."""
    record = F.to_json(F.struct(*[c for c in df.columns if not c.startswith("_") and c != raw]), {"ignoreNullFields": "true"})
    line = F.coalesce(F.col(raw), record) if raw else record
    _ordered(df, [order], line).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def public_record(m: Column | str) -> Column:
    """A map's JSON without keys that start with an underscore."""
    return F.to_json(maps.public_entries(m))


def tsv(df: DataFrame, path: str, order: list[str], columns: list[str], clean: tuple[str, ...] = ("text",), overwrite: bool = False) -> None:
    """Tab-separated lines with a header; tabs in the ``clean`` columns become spaces."""
    cells = [F.regexp_replace(F.col(c), "\t", " ").alias(c) if c in clean else F.col(c) for c in columns]
    out = df.orderBy(*order).select(*cells).coalesce(1)
    out.write.mode("overwrite" if overwrite else "errorifexists").option("escapeQuotes", "false").option("quote", "\u0000").csv(path, sep="\t", header=True)


def json_array(df: DataFrame, order: str) -> str:
    """A small table as an indented JSON array; a report for people, made on the driver."""
    rows = [json.loads(r[0]) for r in df.orderBy(order).select(F.to_json(F.struct(*df.columns))).toLocalIterator()]
    return json.dumps(rows, ensure_ascii=False, indent=2)


def stats_document(df: DataFrame) -> str:
    """A one-row table as JSON."""
    return df.select(F.to_json(F.struct(*df.columns))).first()[0]


def parameters(values: dict[str, object]) -> str:
    """A run's parameters as ``key=value`` lines."""
    return "".join(f"{k}={v}\n" for k, v in values.items())


def markdown_report(title: str, verdict: str, counts: dict[str, int], samples: list[tuple[str, ...]] = ()) -> str:
    """A short report of a validation."""
    lines = [f"# {title}", "", f"Result: **{verdict}**", "", "| check | rows |", "| --- | --- |"]
    lines += [f"| {k} | {v} |" for k, v in counts.items()]
    if samples:
        lines += ["", "## First issues", "", *("- " + " | ".join(s) for s in samples)]
    return "\n".join(lines) + "\n"


def lineage(df: DataFrame) -> DataFrame:
    """The provenance columns of built segments, in their order."""
    wanted = ["out_wav", "cutlist_line", "src_audio", "start", "end", "replaced_audio_path", "text", "text_source", "to_align_sentence_idx", "cutlist_text", "to_align_text"]
    return df.select(*[c for c in wanted if c in df.columns])


def wav_files(df: DataFrame, folder: str, name: str = "wav", content: str = "content") -> None:
    """Each row's bytes as a file in a mounted folder that all workers share; a file appears whole or not at all."""
    target = folder.rstrip("/")

    def write(rows) -> None:
        for row in rows:
            path = Path(target) / row[0]
            part = path.with_name(f".{path.name}.part")
            part.write_bytes(row[1])
            part.replace(path)

    Path(target).mkdir(parents=True, exist_ok=True)
    df.select(name, content).foreachPartition(write)


def versioned(df: DataFrame, root: str, version: str) -> str:
    """A new version of a table beside the earlier ones, instead of an update in place."""
    path = f"{root}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def voice_config(name: str, sample_rate: int, id_map: dict[str, list[int]], speakers: dict[str, int] | None = None, espeak_voice: str = "en-us") -> str:
    """A voice's configuration file."""
    return json.dumps(
        {
            "audio": {"sample_rate": sample_rate, "quality": name},
            "espeak": {"voice": espeak_voice},
            "inference": {"noise_scale": 0.667, "length_scale": 1.0, "noise_w": 0.8},
            "phoneme_type": "espeak",
            "phoneme_id_map": id_map,
            "speaker_id_map": speakers or {},
            "num_symbols": 256,
            "num_speakers": max(1, len(speakers or {})),
            "hop_length": 256,
        },
        ensure_ascii=False,
        indent=2,
    )

