"""The jobs from the command line, for ``spark-submit`` or ``python -m ticketloom``."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from ticketloom import schemas
from ticketloom.operators.language_model import LanguageModel, train_language_model
from ticketloom.operators.tickets import preview
from ticketloom.plans import associations, emails, extract, subjects
from ticketloom.session import build_session
from ticketloom.sinks.csv_files import write_csv
from ticketloom.sources import landed
from ticketloom.sources.tables import read_table


def _provider(name: str | None):
    """``package.module:function``"""
    if not name:
        return None
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


def _landed(spark, args):
    tickets = associations.load_tickets(spark, args.tickets, args.allow_partial)
    read = associations.load_associations(spark, args.associations, args.batches, args.allow_partial)
    return tickets, read


def _export(tables, base) -> None:
    for path in associations.export_tables(tables, base).values():
        print(path)


def extract_tickets(spark, args) -> None:
    found = extract.extract_support_tickets(
        spark, args.mart, args.raw, args.format, as_of=args.as_of, days=args.days,
        pipeline=args.pipeline, source=args.source,
    )
    write_csv(found, args.output, mode="overwrite")


def dump_tickets(spark, args) -> None:
    dump = extract.dump_recent_tickets(
        spark, args.raw, args.output, args.as_of, args.days, args.format
    )
    dump.preview.show(truncate=50)
    dump.written.show()
    print(dump.path)
    _export({"raw_profile": dump.profile}, args.output)


def merge(spark, args) -> None:
    tickets, read = _landed(spark, args)
    print(associations.export_merged(tickets, read.edges, args.output, rejected=read.rejected))
    analysis = associations.analyse_associations(tickets, read.edges, read.rejected)
    analysis.nulls.show()
    tables = {"null_associations": analysis.nulls, "histogram": analysis.histogram, "rejected": read.rejected}
    _export(tables, args.output)


def compare(spark, args) -> None:
    tickets, read = _landed(spark, args)
    report = subjects.compare_subjects(
        tickets, read.edges, landed.read_emails(spark, args.emails), args.sample, args.seed
    )
    report.match_rate.show()
    for examples in (report.matches, report.mismatches):
        preview(examples, ["ticket_id", "ticket_subject", "email_subject"], ["ticket_id"]).show()
    if args.output:
        tables = {"match_rate": report.match_rate, "matches": report.matches, "mismatches": report.mismatches}
        _export(tables | {"rejected": read.rejected}, args.output)


def expand(spark, args) -> None:
    tickets, read = _landed(spark, args)
    found = landed.read_emails(spark, args.emails)
    expanded = associations.expand_emails(tickets, read.edges, found)
    write_csv(expanded.emails, args.output, mode="overwrite")
    print(args.output)
    tables = {"unresolved": expanded.unresolved, "per_ticket": expanded.per_ticket, "rejected": read.rejected}
    _export(tables, f"{args.output.rstrip('/')}_report")


def train(spark, args) -> None:
    texts = read_table(spark, args.texts, args.format)
    train_language_model(texts, args.text_column, args.language_column).write.mode("overwrite").parquet(args.output)
    print(args.output)


def translate(spark, args) -> None:
    model = LanguageModel.of(spark.read.parquet(args.language_model)) if args.language_model else None
    result = emails.process_email_content(
        spark, args.input, args.output, schemas.TICKET_EMAIL, args.source_language,
        provider=_provider(args.provider), detector=_provider(args.detector),
        max_chars=args.max_chars, batch_size=args.batch_size, partitions=args.partitions,
        model=model, phrases=spark.read.parquet(args.phrases) if args.phrases else None, store=args.answers,
    )
    shown = ["ticket_id", "detected_language", "translated_content"]
    preview(result, shown, ["ticket_id"]).show(truncate=False)
    statistics = emails.language_statistics(result, args.source_language)
    statistics.mentions.show()
    tables = {"language_counts": statistics.counts, "language_mentions": statistics.mentions}
    _export(tables, f"{args.output.rstrip('/')}_report")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ticketloom")
    jobs = parser.add_subparsers(required=True)

    def job(name, run, *required):
        p = jobs.add_parser(name)
        p.set_defaults(run=run)
        for option in required:
            p.add_argument(f"--{option}", required=True)
        return p

    for p in (
        job("extract-tickets", extract_tickets, "mart", "raw", "output"),
        job("dump-tickets", dump_tickets, "raw", "output"),
    ):
        p.add_argument("--format", default="parquet", help="a Spark source, or 'table'")
        p.add_argument("--as-of", help="last day of the window, default today")
        p.add_argument("--days", type=int, default=30)
        if p.get_default("run") is extract_tickets:
            p.add_argument("--pipeline", default="Support")
            p.add_argument("--source", default="EMAIL")

    for p in (
        job("merge-associations", merge, "tickets", "output"),
        job("compare-subjects", compare, "tickets", "emails"),
        job("expand-emails", expand, "tickets", "emails", "output"),
    ):
        p.add_argument("--associations", help="per-ticket responses")
        p.add_argument("--batches", help="batch responses, instead or as well")
        p.add_argument("--allow-partial", action="store_true", help="accept missing pages")
        if p.get_default("run") is compare:
            p.add_argument("--sample", type=int, default=100)
            p.add_argument("--seed", default="0")
            p.add_argument("--output", help="where to write the report's tables")

    p = job("train-languages", train, "texts", "output")
    p.add_argument("--format", default="parquet", help="a Spark source, or 'table'")
    p.add_argument("--text-column", default="text")
    p.add_argument("--language-column", default="lang")

    p = job("translate-emails", translate, "input", "output")
    p.add_argument("--language-model", help="what train-languages wrote, default stop words")
    p.add_argument("--phrases", help="Parquet with the columns phrase and answer, instead of the glossary")
    p.add_argument("--answers", help="folder in which the provider's answers are kept")
    p.add_argument("--source-language", default="Dutch")
    p.add_argument("--provider", help="package.module:function, default the glossary")
    p.add_argument("--detector", help="package.module:function, default stop words")
    p.add_argument("--max-chars", type=int, help="cut texts, whole by default")
    p.add_argument("--batch-size", type=int, help="texts per provider call")
    p.add_argument("--partitions", type=int)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(build_session("ticketloom"), args)


if __name__ == "__main__":
    main()
