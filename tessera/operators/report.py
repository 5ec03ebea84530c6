"""Documents about a dataset, from its statistics."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tessera.operators import stats
from tessera.schema import CONVERSATION, MESSAGE, METADATA, SNIPPET, TAXONOMY, TURN_BOUNDS, Taxonomy


@dataclass
class DatasetInfo:
    name: str = "conversations"
    version: str = "1.0.0"
    description: str = "Multi-turn conversations between developers and assistants, made by a program."
    synthetic: bool = True
    generator_model: str = "unknown"
    license: str = "Apache-2.0"
    created_at: str = ""
    splits: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, **defaults) -> DatasetInfo:
        """From JSON; a missing file, and each key that is missing or unknown, leaves the default."""
        given = _json(path)
        return cls(**{**defaults, **{f.name: given[f.name] for f in fields(cls) if f.name in given}})


def _json(path: str) -> dict:
    if not path or not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def load_statistics(path: str) -> dict:
    """Statistics, or none where the file is missing."""
    return _json(path)


def dataset_info(df: DataFrame, **about) -> DatasetInfo:
    """From a table with the column split."""
    return DatasetInfo(**about, splits={r.split: r.n for r in stats.split_sizes(df).orderBy("split").collect()})


def statistics(df: DataFrame, order: str = "conv_id") -> dict:
    """All scalars, split sizes and distributions as one small document."""
    out = stats.scalars(df).first().asDict()
    if "split" in df.columns:
        out["splits"] = {r.split: r.n for r in stats.split_sizes(df).collect()}
    out["distributions"] = {}
    for r in stats.distributions(df, order=order).orderBy("field", "rank").toLocalIterator():
        out["distributions"].setdefault(r.field, []).append({"value": r.value, "count": r["count"], "percentage": r.percentage})
    return out


def example_per_difficulty(df: DataFrame, order: str = "conv_id", limit: int = 3) -> DataFrame:
    """The first conversation of each difficulty, at most limit of them."""
    first = df.groupBy("difficulty").agg(F.min(order).alias(order))
    return first.orderBy(order).limit(limit)


# Pieces of pages


def _table(head: list[str], rows: list[list]) -> str:
    return "\n".join(["| " + " | ".join(map(str, r)) + " |" for r in (head, ["---"] * len(head), *rows)])


def _list(items) -> str:
    return "\n".join(f"- {x}" for x in items)


def _codes(values) -> str:
    return ", ".join(f"`{v}`" for v in values) or "none"


def _number(x) -> str:
    return f"{x:,}" if isinstance(x, int) else "N/A" if x is None else f"{x:,.2f}"


def _label(x: str) -> str:
    return x.replace("_", " ").title()


def _page(title: str, sections: list[tuple[str, str]], lead: str = "", head: str = "") -> str:
    return "\n\n".join([f"{head}# {title}", *([lead] if lead else []), *(f"## {name}\n\n{body}" for name, body in sections)]) + "\n"


def _shares(s: dict, field: str) -> str:
    return _table(["Value", "Count", "Share"], [[f"`{e['value']}`", _number(e["count"]), f"{e['percentage']}%"] for e in s["distributions"][field]])


def _statistics(s: dict) -> str:
    """The scalars and every distribution there is."""
    if not s:
        return "Statistics are not available: they are written when the dataset is split."
    scalars = _table(["Statistic", "Value"], [[_label(k), _number(s.get(k))] for k in ("total_conversations", "average_turns", "code_snippet_coverage", "average_characters")])
    return "\n\n".join([scalars, *(f"### {_label(name)} Distribution\n\n{_shares(s, name)}" for name in sorted(s.get("distributions", {})))])


def _splits(info: DatasetInfo) -> str:
    total = sum(info.splits.values())
    return _table(["Split", "Conversations", "Share"], [[k, _number(v), f"{100 * v / total:.1f}%"] for k, v in info.splits.items() if total]) if info.splits else "No splits have been written."


def total(info: DatasetInfo, s: dict) -> int:
    return s.get("total_conversations") or sum(info.splits.values())


def _struct(kind: str) -> StructType:
    return StructType.fromDDL(f"x {kind}")["x"].dataType if kind.startswith("struct<") else StructType.fromDDL(kind)


def _field_rows(kind: str, required: tuple[str, ...]) -> str:
    """A table of fields; inner records are named, their own tables follow."""
    inner = {_struct(k).simpleString(): name for name, k in (("Message", MESSAGE), ("CodeSnippet", SNIPPET), ("ConversationMetadata", METADATA))}

    def shown(t) -> str:
        if isinstance(t, ArrayType):
            return f"list of {shown(t.elementType)}"
        return inner.get(t.simpleString(), "object" if isinstance(t, StructType) else t.simpleString())

    return _table(["Field", "Type", "Required"], [[f"`{f.name}`", shown(f.dataType), "✅" if f.name in required else "❌"] for f in _struct(kind).fields])


def _fields() -> str:
    return _field_rows(CONVERSATION, ("id", "task_type", "difficulty", "language", "messages"))


def _example(e: dict) -> str:
    snippets = lambda m: "".join(f"\n\n```{c.get('language', '')}\n{c.get('code', '')}\n```" for c in m.get("code_snippets") or ())
    return "\n\n".join(f"**{_label(m['role'])}**: {m['content']}{snippets(m)}" for m in e.get("messages", ()))


def _titled(title: str, e: dict) -> str:
    facts = [f"{k}: `{e[v]}`" for k, v in (("Difficulty", "difficulty"), ("Category", "category"), ("Language", "language")) if e.get(v)]
    return "\n\n".join([f"### {title}", " · ".join(facts), _example(e)])


def _turn(role: str, content: str, language: str = "", code: str = "") -> dict:
    return {"role": role, "content": content, "code_snippets": [{"language": language, "code": code}] if code else []}


#: Written for the page of examples: title, difficulty, category, language, question, answer, code.
CURATED = (
    ("Beginner", "easy", "feature_request", "python", "How do I count the words of a line?", "Split it at white space and take the length.", "def words(line):\n    return len(line.split())"),
    ("Intermediate", "medium", "refactor", "typescript", "This parser throws on bad input. Can callers see the failure in its type?", "Return a union, so that the compiler asks for both cases.", "type Parsed = { ok: true; value: number } | { ok: false; reason: string };"),
    ("Advanced", "hard", "architecture_discussion", "go", "Cancelling a request leaves its workers running. How do they learn of it?", "Hand the request's context to each and select on its end.", "select {\ncase <-ctx.Done():\n\treturn ctx.Err()\ncase job := <-jobs:\n\trun(job)\n}"),
    ("Debugging", "medium", "debugging_session", "typescript", "A list is sorted as 1, 10, 2. Why?", "Without a comparison, values are sorted as text.", "counts.sort((a, b) => a - b);"),
    ("Code Review", "medium", "code_review", "rust", "Please review this loader before I merge it.", "It ends the program when the file is missing. Let the caller decide.", "fn load(path: &Path) -> io::Result<String> {\n    fs::read_to_string(path)\n}"),
    ("Optimization", "hard", "refactor", "java", "Joining a million lines takes minutes.", "Each step copies all that is there. Append to one buffer.", 'var out = new StringBuilder();\nfor (var line : lines) out.append(line).append("\\n");'),
    ("System Design", "hard", "architecture_discussion", "python", "How can a job that runs twice by mistake do no harm?", "Give each run a key and record it with the result in one transaction.", "if not ledger.insert_once(run_key, result):\n    return ledger.result(run_key)"),
)
#: (stage, what it does); the pages name them in this order.
STAGES = (
    ("Scenario Generation", "Specifications are laid out by a coverage matrix, so that the values of a dimension occur equally often."),
    ("Prompt Construction", "A template is filled with the fields of a specification; one that names an unknown field is refused."),
    ("Model Calls (OpenRouter or another chat service)", "Requests that fail are made again, each time after twice the wait. An error that no retry mends ends the run."),
    ("Schema Validation", "A reply's JSON is found, completed and held against structure and taxonomy; lengths, turn counts and coverage must agree."),
    ("PII Detection", "Addresses, telephone numbers and the like in a record reject it."),
    ("Deduplication", "Records equal to an earlier one, or more similar to it than a threshold, are dropped."),
    ("Quality Scoring", "A judge scores four dimensions; a weighted mean below the threshold rejects the record."),
    ("Dataset Split", "Strata are split by a seeded order. No record is in two splits."),
)


def _stages() -> str:
    return "\n".join(f"{i}. **{name}**: {what}" for i, (name, what) in enumerate(STAGES, 1))


# Pages


def readme(info: DatasetInfo, s: dict, examples: list[dict], tax: Taxonomy = TAXONOMY) -> str:
    """A title and 15 sections."""
    origin = "written by a program" if info.synthetic else "collected"
    return _page(info.name, [
        ("Features", _list([f"{len(tax.categories)} categories, {len(tax.subcategories)} subcategories and {len(tax.intents)} intents", f"{len(tax.languages)} programming languages", "Coverage that is even by construction", "Every record checked, scored and free of copies"])),
        ("Dataset Overview", _table(["Property", "Value"], [["Conversations", _number(total(info, s))], ["Origin", origin], ["Model", info.generator_model], ["Created", info.created_at[:10] or "unknown"]]) + "\n\n" + _splits(info)),
        ("Folder Structure", "```text\n" + "\n".join([*(f"split={k}/" for k in info.splits or ("train", "validation", "test")), "docs/", "README.md"]) + "\n```"),
        ("Installation", "Reading needs a Python with PySpark:\n\n```python\nspark.read.json(path)\n```"),
        ("Dataset Schema", _fields() + "\n\nAll tables of fields: `docs/schema.md`."),
        ("Categories", _list(f"`{c}`" for c in tax.categories)),
        ("Statistics", _statistics(s)),
        ("Example Conversation", _example(examples[0]) if examples else "No example is available."),
        ("How the Dataset Was Generated", _stages()),
        ("Validation Pipeline", _list(f"{name}: {what}" for name, what in STAGES[3:7])),
        ("Roadmap", _list(["More languages and tools", "Longer conversations", "Judgements by people for a part of the records"])),
        ("Version", f"{info.version} ({info.created_at[:10] or 'undated'}). Changes: `CHANGELOG.md`."),
        ("License", f"{info.license}; the text is in `LICENSE`."),
        ("Citation", f"`CITATION.cff` holds what to cite:\n\n```bibtex\n{bibtex(info)}\n```"),
        ("Contributing", "Report records that are wrong by their `id`. A change of the taxonomy needs a new version."),
    ], info.description)


def card(info: DatasetInfo, s: dict, tax: Taxonomy = TAXONOMY) -> str:
    """A YAML header, a title and 17 sections."""
    n = total(info, s)
    size = next((f"n<{name}" if not low else f"{low}<n<{name}" for low, name, most in (("", "1K", 10**3), ("1K", "10K", 10**4), ("10K", "100K", 10**5), ("100K", "1M", 10**6)) if n < most), "n>1M")
    about = {"license": info.license.lower(), "pretty_name": info.name, "language": ["en"], "task_categories": ["text-generation"], "size_categories": [size], "tags": ["conversations", "code", *(["synthetic"] if info.synthetic else [])]}
    return _page(f"Dataset card: {info.name}", [
        ("Overview", f"{info.description} Version {info.version}, {_number(n)} conversations, made with {info.generator_model}."),
        ("Motivation", "Public logs of how developers work with assistants are few and hold personal data. Written conversations have neither fault, and their coverage can be chosen."),
        ("Intended Use", _list(["Tuning assistants for software development", "Testing pipelines that read conversations", "Studying the effect of coverage on a model"])),
        ("Out-of-Scope Use", _list(["Measuring how often people ask for what", "Advice that no one checks", "Training on the test split"])),
        ("Dataset Structure", _splits(info)),
        ("Schema", _fields()),
        ("Supported Tasks", _list(f"`{t}`" for t in tax.task_types)),
        ("Languages", f"English prose; code in {_codes(tax.languages)}."),
        ("Categories", _list(f"`{c}`" for c in tax.categories)),
        ("Statistics", _statistics(s)),
        ("Generation Methodology", _list(f"{name}: {what}" for name, what in STAGES[:3])),
        ("Validation Methodology", _list(f"{name}: {what}" for name, what in STAGES[3:])),
        ("Known Limitations", _list(["Code is not run", "Turns follow a few patterns", "A judge model shares faults with the model that writes"])),
        ("Bias Discussion", "Even coverage is a choice: rare tasks occur as often as common ones. Wording and habits are those of the model that wrote the text."),
        ("Privacy Statement", "No record was taken from a person. Text that looks like personal data is found by patterns and rejected; patterns miss some and find some that is none."),
        ("Ethical Considerations", "Generated code may be insecure or resemble code that others own. Models tuned on this data should say what they are."),
        ("Citation", f"```bibtex\n{bibtex(info)}\n```"),
    ], head="---\n" + "\n".join(f"{k}: {json.dumps(v)}" for k, v in about.items()) + "\n---\n\n")


def examples_page(info: DatasetInfo, examples: list[dict]) -> str:
    """Those of the dataset, if there are any, then the curated ones."""
    own = [_titled(f"Example {i}: {_label(e.get('category') or e.get('task_type') or '')}", e) for i, e in enumerate(examples, 1)]
    written = [_titled(title, {"difficulty": d, "category": c, "language": lang, "messages": [_turn("user", asked), _turn("assistant", said, lang, code)]}) for title, d, c, lang, asked, said, code in CURATED]
    note = f"Of {info.name}, version {info.version}. All examples are synthetically generated; none is of a real person."
    return _page("Examples", [*([("From the Dataset", "\n\n".join(own))] if own else []), ("Curated Examples", "\n\n".join(written))], note)


def schema_page(tax: Taxonomy = TAXONOMY) -> str:
    limits = [["`conversation_length`", ", ".join(f"`{k}`: {a} to {b} messages" for k, (a, b) in TURN_BOUNDS.items())], *([f"`{k}`", _codes(getattr(tax, v))] for k, v in (("task_type", "task_types"), ("difficulty", "difficulties"), ("language", "languages"), ("role", "roles"), ("tools", "tools")))]
    return _page("Schema", [
        ("Conversation", _fields()),
        ("Message", _field_rows(MESSAGE, ("role", "content"))),
        ("CodeSnippet", _field_rows(SNIPPET, ("language", "code"))),
        ("ConversationMetadata", _field_rows(METADATA, ())),
        ("Field Value Constraints", _table(["Field", "Allowed"], limits)),
    ])


_HEADINGS = {"difficulties": "Difficulty Levels", "languages": "Programming Languages"}


def taxonomy_page(tax: Taxonomy = TAXONOMY) -> str:
    lists = [(_HEADINGS.get(k, _label(k)), _list(f"`{v}`" for v in vs) if vs else "No values.") for k, vs in asdict(tax).items()]
    return _page("Taxonomy", [*lists, ("Turns", _table(["Length", "Least", "Most"], [[k, a, b] for k, (a, b) in TURN_BOUNDS.items()]))])


def pipeline_page(info: DatasetInfo) -> str:
    return _page("Pipeline", [("Stages", _stages()), ("Model", f"`{info.generator_model}`"), *((f"{i}. {name}", what) for i, (name, what) in enumerate(STAGES, 1))])


def changelog(info: DatasetInfo, s: dict) -> str:
    made = [f"{_number(total(info, s))} conversations", *(f"{k}: {_number(v)}" for k, v in info.splits.items()), f"Model: {info.generator_model}"]
    return _page("Changelog", [(f"v{info.version} ({info.created_at[:10] or 'undated'})", _list(made))])


def bibtex(info: DatasetInfo) -> str:
    return f"@misc{{{info.name},\n  title = {{{info.name}}},\n  version = {{{info.version}}},\n  year = {{{info.created_at[:4]}}}\n}}"


def citation(info: DatasetInfo) -> str:
    """Citation File Format. JSON strings are YAML."""
    facts = {"title": info.name, "message": "Please cite this dataset by these data.", "version": info.version, "license": info.license, "abstract": info.description, **({"date-released": info.created_at[:10]} if info.created_at else {})}
    rest = {"keywords": ["conversations", "software development", "synthetic data"], "authors": [{"name": f"Contributors to {info.name}"}]}
    return "\n".join(["cff-version: 1.2.0", "type: dataset", *(f"{k}: {json.dumps(v, ensure_ascii=False)}" for k, v in (facts | rest).items())]) + "\n"


def write_docs(folder: str, info: DatasetInfo, s: dict, examples: list[dict], tax: Taxonomy = TAXONOMY) -> list[str]:
    """Nine files, their names; an existing licence is left alone."""
    pages = {
        "README.md": readme(info, s, examples, tax), "DATASET_CARD.md": card(info, s, tax), "CHANGELOG.md": changelog(info, s), "CITATION.cff": citation(info),
        "docs/schema.md": schema_page(tax), "docs/taxonomy.md": taxonomy_page(tax), "docs/generation_pipeline.md": pipeline_page(info), "docs/examples.md": examples_page(info, examples),
    }
    if not os.path.exists(os.path.join(folder, "LICENSE")):
        pages["LICENSE"] = f"{info.name} is licensed under {info.license}.\n"
    os.makedirs(os.path.join(folder, "docs"), exist_ok=True)
    for name, text in pages.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    return sorted(pages)
