"""Curated seed files: a short list kept by hand, read and checked on the driver."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.ids import ZERO_ADDRESS
from ..operators.labels import TAXONOMY

#: Fixed value: the exact header.
HEADER = ("chain_id", "address", "entity_name", "entity_category", "contract_role", "source_type", "source_reference", "confidence", "notes")
SCHEMA = ("chain_id bigint, address string, entity_name string, entity_category string, contract_role string, source_type string, "
          "source_reference string, confidence double, notes string")


def _checked(row: dict, line: int) -> dict:
    def bad(what):
        raise ValueError(f"line {line}: {what}")

    clean = {k: (v or "").strip() for k, v in row.items()}
    if not re.fullmatch("[0-9]+", clean["chain_id"]) or int(clean["chain_id"]) <= 0:
        bad("chain_id must be a positive integer")
    if not re.fullmatch("0x[0-9a-fA-F]{40}", clean["address"]):
        bad("address must be 20 hex bytes")
    if clean["address"].lower() == ZERO_ADDRESS:
        bad("the zero address is no wallet")
    for name in ("entity_name", "source_type", "source_reference"):
        if not clean[name]:
            bad(f"{name} must not be empty")
    category, role = clean["entity_category"].lower(), clean["contract_role"].lower() or None
    if category not in TAXONOMY["entity_category"]:
        bad(f"unknown entity_category: {category}")
    if role is not None and role not in TAXONOMY["contract_role"]:
        bad(f"unknown contract_role: {role}")
    try:
        confidence = float(clean["confidence"])
    except ValueError:
        bad("confidence must be a number")
    if not 0.0 <= confidence <= 1.0:
        bad("confidence must be in [0,1]")
    return clean | {"chain_id": int(clean["chain_id"]), "address": clean["address"].lower(), "entity_name": " ".join(clean["entity_name"].split()),
                    "entity_category": category, "contract_role": role, "source_type": clean["source_type"].lower(), "confidence": confidence, "notes": clean["notes"] or None}


def parse(text: str) -> list[dict]:
    """Checked rows by (chain, address); identical repeats collapse, other repeats raise."""
    reader = csv.DictReader(io.StringIO(text.removeprefix("﻿")))
    if tuple(reader.fieldnames or ()) != HEADER:
        raise ValueError("the header must be " + ",".join(HEADER))
    found: dict[tuple, dict] = {}
    for row in reader:
        if None in row:
            raise ValueError(f"line {reader.line_num}: too many fields")
        clean = _checked(row, reader.line_num)
        key = clean["chain_id"], clean["address"]
        if found.setdefault(key, clean) != clean:
            raise ValueError(f"line {reader.line_num}: conflicting rows for {key[1]}")
    return [found[k] for k in sorted(found)]


def digest(rows: list[dict]) -> str:
    """Version of a seed list: SHA-256 of its rows as compact sorted JSON.

    Fixed: the columns of the header as keys, the confidence with 17 digits, absent values empty.
    """
    written = {"confidence": lambda x: format(x, ".17g"), "contract_role": lambda x: x or "", "notes": lambda x: x or ""}
    same = lambda x: x
    ordered = [{c: written.get(c, same)(r[c]) for c in HEADER} for r in sorted(rows, key=lambda r: (r["chain_id"], r["address"]))]
    text = json.dumps(ordered, sort_keys=True, separators=(",", ":"))
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def read(spark: SparkSession, path: str) -> list[dict]:
    """Read through Spark, so any store will do; a seed list is small by its nature."""
    return parse(spark.read.text(path, wholetext=True).first()[0])


def to_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r[c] for c in HEADER) for r in rows], SCHEMA)
