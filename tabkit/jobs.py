"""End-to-end jobs: sources -> operators -> sinks, one call each.

``asof`` is an explicit argument everywhere (no wall clock inside).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabkit.operators import claims as C
from tabkit.operators import soap
from tabkit.scratch import Scratch
from tabkit.sinks.files import archive_file, write_delimited, write_named_text
from tabkit.sources.daywindow import read_hive_window, read_named_days
from tabkit.sources.delimited import SourceSpec, all_text_schema, read_pipe_with_header


def _claims_and_catalogue(spark, claims_path, catalogue_path):
    claims = read_pipe_with_header(spark, claims_path, all_text_schema(C.CLAIM_COLUMNS))
    catalogue = read_pipe_with_header(spark, catalogue_path, all_text_schema(C.CATALOGUE_COLUMNS))
    return claims, catalogue


def mobile_claims_job(spark: SparkSession, claims_path: str, catalogue_path: str, calls_base: str,
                      asof, months: int, out_path: str | None = None, files: int | None = None,
                      day_pattern=None, archive_dir: str | None = None):
    """Mobile claims detail. Calls: header-less ``|`` files below one folder
    per day (``<base>/YYYYMMDD/*/*.DAT`` by default); missing days are
    skipped and reported. Output: ``|`` CSV without header.
    Returns ``(detail, skipped_days)``."""
    claims, catalogue = _claims_and_catalogue(spark, claims_path, catalogue_path)
    pattern = day_pattern or (lambda d: f"{calls_base}/{d:%Y%m%d}/*/*.DAT")
    raw, skipped = read_named_days(spark, pattern,
                                   SourceSpec("csv", "|", False, all_text_schema(C.MOBILE_CALL_COLUMNS)),
                                   asof, months)
    detail = C.claims_detail(claims, C.mobile_calls(raw), catalogue)
    if out_path:
        write_delimited(detail, out_path, sep="|", header=False, files=files)
        if archive_dir:
            archive_file(spark, claims_path, archive_dir)
    return detail, skipped


def fixed_claims_job(spark: SparkSession, claims_path: str, catalogue_path: str, incoming_base: str,
                     asof, months: int, out_path: str | None = None, files: int | None = None,
                     outgoing_base: str | None = None, outgoing_pattern=None,
                     archive_dir: str | None = None) -> DataFrame:
    """Fixed-line claims detail. Incoming calls: hive day folders
    ``<base>/fecha_comunicacion=YYYY-MM-DD/delta*/*`` read through one pruned
    scan. Outgoing records (comma separated, day in the file name) are added
    only when ``outgoing_base`` is given, assumed in the incoming layout.
    Output: ``|`` CSV with header."""
    claims, catalogue = _claims_and_catalogue(spark, claims_path, catalogue_path)
    spec = SourceSpec("csv", "|", False, all_text_schema(C.FIXED_CALL_COLUMNS + ["fecha_comunicacion"]))
    calls = C.fixed_calls(read_hive_window(spark, incoming_base, spec, "fecha_comunicacion", asof, months))
    if outgoing_base:
        pattern = outgoing_pattern or (lambda d: f"{outgoing_base}/*_{d:%Y%m%d}*.DAT")
        out_raw, _ = read_named_days(spark, pattern,
                                     SourceSpec("csv", ",", False, all_text_schema(C.FIXED_CALL_COLUMNS)),
                                     asof, months)
        calls = calls.unionByName(C.fixed_calls(out_raw))
    detail = C.claims_detail(claims, calls, catalogue)
    if out_path:
        write_delimited(detail, out_path, sep="|", header=True, files=files)
        if archive_dir:
            archive_file(spark, claims_path, archive_dir)
    return detail


def cancel_mapping_job(spark: SparkSession, in_dir: str, out_dir: str, reject_dir: str,
                       ns: soap.CancelNamespaces = soap.CancelNamespaces(),
                       one_dir_per_name: bool = False, by_folder: str | None = None):
    """Every cancel message of ``in_dir`` -> rendered messages (same file
    names) + a reject table ``(file_name, reason)``. The files are listed and
    read once."""
    messages = Scratch(spark, "messages").table(soap.read_messages(spark, in_dir, by_folder), "read")
    ok, bad = soap.cancel_job(messages, ns)
    write_named_text(ok, out_dir, "file_name", "xml", one_dir_per_name=one_dir_per_name)
    bad.write.mode("overwrite").parquet(reject_dir)
    return ok, bad


def close_mapping_job(spark: SparkSession, in_dir: str, out_dir: str, reject_dir: str,
                      ns: soap.CloseNamespaces = soap.CloseNamespaces(),
                      one_dir_per_name: bool = False):
    messages = Scratch(spark, "messages").table(soap.read_messages(spark, in_dir), "read")
    ok, bad = soap.close_job(messages, ns)
    write_named_text(ok, out_dir, "file_name", "xml", one_dir_per_name=one_dir_per_name)
    bad.write.mode("overwrite").parquet(reject_dir)
    return ok, bad
