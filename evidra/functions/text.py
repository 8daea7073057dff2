"""Text features as Column expressions: tokens, n-grams, labels, credentials.

Patterns are written for Java; (?iu) and (?U) give them the Unicode case and word rules they mean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns, word lists and label names below define results and are data, not design.
TOKEN = r"[A-Za-z_][A-Za-z0-9_.:/-]*|[一-鿿]{2,}"
FILE = r"(?i)(?<![A-Za-z0-9_])(?:[A-Za-z0-9_.-]+/)*[A-Za-z0-9_.-]+\.(?:py|js|mjs|ts|tsx|jsx|json|yaml|yml)(?![A-Za-z0-9_])"
SYMBOL = r"\b[A-Za-z_][A-Za-z0-9_]{2,}(?=\s*\(|\s*::)|\b(?:Attribute|stdin|stdout|SAFE_NAMES|EXPRESSION|checker)\b"
IDENTIFIER = r"(?:[A-Za-z0-9_.-]+/)+[A-Za-z0-9_.-]+|[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)+|[A-Za-z_][A-Za-z0-9_]{2,}"
SEMANTIC_TOKEN = r"(?i)(?:[A-Za-z0-9_.-]+/)+[A-Za-z0-9_.-]+|[A-Za-z_][A-Za-z0-9_.-]{3,}|\d+(?:\.\d+)?(?:\s*(?:秒|分钟|小时|天|日|月|年))?"
TEMPORAL_VALUE = r"(?i)datetime\s*\([^)]*\)|\b20\d{2}(?:[-/.]\d{1,2}){0,2}\b|\d+(?:\.\d+)?\s*(?:秒|分钟|小时|天|日|月|年)"
CHINESE = r"[一-鿿]{2,}"
CHINESE_EXPLICIT = r"`([^`\n]{3,48})`|[\"“「《]([^\"”」》\n]{3,48})[\"”」》]"
CHINESE_STOP = "用户 助手 要求 认为 可以 需要 目前 这个 那个 然后 已经 进行 问题 内容 对应 相关 时候 里面 一下 一个 版本 快照 事件 文件 代码 函数 模块 旧版 新版 当前 历史 工具 结果 输出 记录 数据 实现 逻辑 路径 修改".split()
RELATION_LABELS = "change failure validation feedback constraint decision temporal conditional".split()
TOPIC = "(?iu)现在|然后|另外|接下来|换个|继续|最后|总结|部署|安装|测试|评估|设计|实现|修复|导出|分析|对比|之前|后来|改成|改为|修改|保留|删除|移除|反馈|失败|报错|要求|确认|可以吗|怎么|为什么|如何|需要|帮我|我想|我认为|同意|好的"
RELATION_CUE = "(?iu)之前|后来|现在|然后|改成|修改|保留|删除|移除|必须|不要|不能|通过|失败|报错|要求|反馈|确认|计划"
REFERENCE_CUE = "(?iu)之前|此前|前面|上述|原来|这个(?:决定|约束|方案)|该(?:决定|约束|方案)"
FEEDBACK_CUE = "(?iu)反馈|问题是|不对|不符合"
BEFORE = "(?iu)修改前|补丁前|之前|此前|旧版|原先|当时|before|previous"
AFTER = "(?iu)修改后|补丁后|之后|后来|新版|当前|截止|after|later|current"
CONDITION = r"(?iu)[A-Za-z_][A-Za-z0-9_.-]*\s*(?:==|!=|<=|>=|<|>)\s*[^\s,，。；;]+|(?<!\d)\d+(?!\d)|enabled|disabled|enable|disable|启用|禁用|开启|关闭|(?:不|未|无|非)[一-鿿A-Za-z_]{1,8}"
EVENT_LABELS = {
    "feedback": "(?iu)反馈|不对|没[有能]|差点意思|不符合|问题是|要求|希望|应该",
    "failure": "(?iu)失败|报错|错误|异常|crash|error|failed|failure|bug",
    "validation": "(?iu)测试|实验|验证|结果|通过|命中|改善|提升|回归|benchmark",
    "design": "(?iu)方案|设计|改成|改为|采用|重构|实现|增加|引入",
}
FACT_LABELS = {
    "failure": "(?iu)失败|报错|错误|异常|crash|error|failed|failure|bug",
    "validation": "(?iu)测试|实验|验证|通过|passed|pytest|结果|回归",
    "change": "(?iu)修改|改为|改成|删除|新增|移除|替换|升级|迁移|补丁|版本",
    "feedback": "(?iu)反馈|不对|不需要|不能|应该|希望|要求|同意|确认",
    "constraint": r"(?iu)必须|只允许|不要|不能|限制|兼容|默认|约束|要求|需要|\bmust\b|require|constraint",
    "decision": "(?iu)决定|采用|选择|方案|最终|保留|放弃|decided|agreed|confirmed",
    "temporal": "(?iu)之前|之后|后来|先|再|当前|当时|历史|旧版|新版|曾经",
    "conditional": r"(?iu)如果|当.+时|只有|否则|unless|when|if\b",
}
WEAK_OBJECTS = "之后 后来 现在 然后 这个 那个 一个 问题 方案 要求 内容 部分 结果 实现 修改 确认 支持 使用 需要 应该 不能 可以 用户 助手".split()
GENERIC_BLOCK_TOKENS = "answer config detail function question result script test tests time value 代码 文件 函数 结果 问题".split()
STOPWORDS = "assistant dialogue error file function model result source test tests true false none python 用户 助手".split()
GENERIC_ENTITIES = (
    "version snapshot event record source file module function code current latest old new history change result output "
    "error failure test tests true false none unknown script command time wall seconds completed success successful "
    "run running status message text data value values str int bool float list dict tuple set bytes mapping optional literal typealias dataclass self"
).split()
PRIVATE_KEY = r"(?i)-----BEGIN [^-\n]*PRIVATE KEY-----"
BEARER = r"(?i)\bbearer\s+[A-Za-z0-9._~-]{8,}"
PREFIX_TOKEN = r"(?i)(?<![A-Za-z0-9])(?:ghp_|github_pat_|sk-|xox[baprs]-)[A-Za-z0-9_-]{16,}"
URL_CREDENTIAL = r"(?i)https?://[^/\s:@]+:[^/\s@]+@"
ASSIGNMENT = "(?i)[\"']?\\b(?:api[_-]?key|access[_-]?token|secret|password|passwd|token)[\"']?\\s*[:=]\\s*[\"']?([^\\s,\"'`]+)"
NATURAL_CREDENTIAL = "(?iu)\\b(?:api\\s*key|access\\s*token|secret|password|passwd|token|凭据|密码)\\s*(?:is|为|是|叫作|叫做)\\s*[\"'`]?([^\\s,，。；;\"'`]+)"
CREDENTIAL_LABEL = "(?i)[\"']?\\b(?:api[_-]?key|access[_-]?token|secret|password|passwd|token)[\"']?\\s*[:=]"
SAFE_VALUE = r"(?i)^(?:none|null|nil|empty|placeholder|example|dummy|your[_-]?token|<[^>]+>|\*{3,}|os\.environ(?:\[[^]]+\])?|\$\{?[A-Z0-9_]+\}?)$"
TRUNCATED = r"(?i)truncated output|output truncated|\[\.\.\.truncated"
USER_PATH = "(?<![A-Za-z0-9:/])(?:/(?:Users|home)/[^/\\s`'\"<>，。]+|[A-Za-z]:[\\\\/]Users[\\\\/][^\\\\/\\s`'\"<>，。]+)(?=[\\\\/\\s`'\"<>，。]|$)"
INTERNAL_ID = r"(?i)(?<![A-Za-z0-9_])(?:e|f)\d+(?![A-Za-z0-9_.(])|(?<![A-Za-z0-9_])(?:code|general)_s\d+_c\d+_f\d+(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?:stage|chunk|scope)[-_]?\d+(?![A-Za-z0-9_])"
INTERNAL_NAME = "该条记录"
URL = r"https?://[^\s<>\"')]+"


def found(text: Column, pattern: str) -> Column:
    """All matches in order; none for a null text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def tokens(text: Column) -> Column:
    """The distinct lower-cased tokens of a message."""
    return F.array_distinct(F.transform(found(text, TOKEN), F.lower))


def normalized(text: Column) -> Column:
    """Lower case, single spaces, none at the ends; operators, digits and negation stay."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def ngrams(text: Column, width: int = 3) -> Column:
    """Distinct character n-grams of the normalized text; a short text is its own."""

    def cut(chars: Column) -> Column:  # an array, so that no place is sought from the text's start
        many = F.transform(F.sequence(F.lit(0), F.size(chars) - width), lambda i: F.array_join(F.slice(chars, i + 1, F.lit(width)), ""))
        return F.when(F.size(chars) == 0, F.slice(chars, 1, 0)).when(F.size(chars) <= width, F.array(F.array_join(chars, ""))).otherwise(F.array_distinct(many))

    return F.flatten(F.transform(F.array(F.regexp_extract_all(normalized(text), F.lit("(?s)."), F.lit(0))), cut))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Shared elements by the smaller set's size; null if either is empty."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.least(F.size(a), F.size(b)), F.lit(0))


def text_contains(left: Column, right: Column, threshold: float = 0.78) -> Column:
    return F.coalesce(overlap_coefficient(ngrams(left), ngrams(right)) >= threshold, F.lit(False))


def labels(text: Column, catalogue: dict[str, str]) -> Column:
    """The names whose pattern occurs in the text, sorted."""
    return F.array_sort(F.array_compact(F.array(*(F.when(text.rlike(p), F.lit(n)) for n, p in catalogue.items()))))


def holds(text: Column, *stems: str) -> Column:
    """Whether one of the stems occurs in any case: a cheap condition for patterns that can't match without one."""
    low = F.translate(F.lower(text), "ſı", "si")  # what (?iu) takes for s and i
    out = low.contains(stems[0])
    for s in stems[1:]:
        out = out | low.contains(s)
    return out


def credential_detected(text: Column) -> Column:
    """Whether the text holds a concrete secret: a known form, or an assignment whose value is no placeholder."""
    def unsafe(pattern: str, *stems: str) -> Column:
        values = F.coalesce(F.when(holds(text, *stems), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))), F.array().cast("array<string>"))
        clean = F.transform(values, lambda v: F.regexp_replace(F.btrim(v), r"^[.;]+|[.;]+$", ""))
        return F.exists(clean, lambda v: (v != "") & ~v.rlike(SAFE_VALUE) & ~F.lower(v).startswith("os.environ["))

    known = [(PRIVATE_KEY, ("-----begin ",)), (BEARER, ("bearer",)), (PREFIX_TOKEN, ("ghp_", "github_pat_", "sk-", "xox")), (URL_CREDENTIAL, ("://",))]
    out = F.lit(False)
    for pattern, stems in known:
        out = out | (holds(text, *stems) & text.rlike(pattern))
    words = ("api", "access", "secret", "passw", "token")
    return F.coalesce(out | unsafe(ASSIGNMENT, *words) | unsafe(NATURAL_CREDENTIAL, *words, "凭据", "密码"), F.lit(False))


def redact_assignments(text: Column) -> Column:
    for pattern, to in ((ASSIGNMENT, "<credential assignment omitted>"), (NATURAL_CREDENTIAL, "<credential assignment omitted>"), (CREDENTIAL_LABEL, "<credential label omitted>")):
        text = F.regexp_replace(text, pattern, to)
    return text


def outside_urls(text: Column, change) -> Column:
    """change applied to what lies between URLs; most texts have none and are changed whole."""
    t = F.coalesce(text, F.lit(""))
    runs = found(t, f"{URL}|(?!https?://)[\\s\\S]+?(?=https?://|\\z)|https?://")
    cut = F.array_join(F.transform(runs, lambda r: F.when(r.rlike(f"^{URL}"), r).otherwise(change(r))), "")
    return F.when(t.contains("http://") | t.contains("https://"), cut).otherwise(change(t))


def redact_paths(text: Column, workspaces: list[str] = ()) -> Column:
    """Workspace roots, longest first, become <workspace> and user homes ~, outside URLs."""
    def change(run: Column) -> Column:
        for root in sorted(workspaces, key=len, reverse=True):
            run = F.replace(run, F.lit(root), F.lit("<workspace>"))
        homes = F.when(run.contains("Users") | run.contains("/home/"), F.regexp_replace(run, USER_PATH, "~")).otherwise(run)
        return F.regexp_replace(homes, INTERNAL_ID, INTERNAL_NAME)

    return outside_urls(text, change)


def csv_tokens(text: Column) -> Column:
    """Comma-separated tokens; none, n/a and - mean no token."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "[,，]"), lambda p: F.btrim(p))
    return F.filter(parts, lambda p: (p != "") & ~F.lower(p).isin("none", "n/a", "-"))


def assignments(text: Column) -> Column:
    """key=value;... as a map; null if a key repeats or a key or value is missing."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.btrim(p)), lambda p: p != "")
    keys = F.transform(parts, lambda p: F.btrim(F.substring_index(p, "=", 1)))
    values = F.transform(parts, lambda p: F.when(p.contains("="), F.btrim(F.substring(p, F.locate("=", p) + 1, F.length(p)))).otherwise(""))
    ok = ~F.exists(keys, lambda k: k == "") & ~F.exists(values, lambda v: v == "") & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(ok, F.map_from_arrays(keys, values))


def key_values(text: Column, keys: list[str]) -> Column:
    """map of KEY to the last line `KEY: value`."""
    return F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*(F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all(text, F.lit(f"(?m)^{k}:\\s*(.*)$"), F.lit(1))), -1) for k in keys)))


def entities(text: Column) -> Column:
    """Concrete lower-cased identifiers: no stop or generic word, record, stage, chunk or scope id, short word or code file name.

    Of Chinese runs the four-character terms without a stop word (zh:), and quoted or marked terms whole (zhx:).
    """
    names = F.transform(found(text, IDENTIFIER), lambda t: F.lower(F.regexp_replace(t, r"^[.]+|[.]+$", "")))
    drop = STOPWORDS + GENERIC_ENTITIES
    latin = F.filter(names, lambda t: (F.length(t) >= 3) & ~t.isin(*drop) & ~t.rlike(r"^[ev]\d+$|^(?:stage|chunk|scope)[-_]?\d+$") & ~t.rlike(r"\.(?:py|js|mjs|ts|tsx|jsx|json|yaml|yml)$"))
    runs = F.flatten(F.transform(found(text, CHINESE), lambda r: F.when(F.length(r) >= 4, F.transform(F.sequence(F.lit(1), F.length(r) - 3), lambda i: F.substring(r, i, F.lit(4)))).otherwise(F.array().cast("array<string>"))))
    terms = F.transform(F.filter(runs, lambda t: ~t.rlike("|".join(CHINESE_STOP))), lambda t: F.concat(F.lit("zh:"), t))
    marked = F.concat(*(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHINESE_EXPLICIT), F.lit(g)) for g in (1, 2)))
    marked = F.filter(F.transform(marked, lambda t: F.lower(F.regexp_replace(t, r"(?U)\s+", ""))), lambda t: t.rlike("[一-鿿]") & ~t.isin(*CHINESE_STOP))
    return F.array_distinct(F.concat(latin, terms, F.transform(marked, lambda t: F.concat(F.lit("zhx:"), t))))


def normalize_path(path: Column, workspace: Column) -> Column:
    """Forward slashes; a declared workspace prefix goes, nothing else."""
    p, w = F.translate(path, "\\", "/"), F.regexp_replace(F.translate(workspace, "\\", "/"), "/+$", "")
    return F.when(w.isNotNull() & (w != "") & p.startswith(F.concat(w, F.lit("/"))), F.substring(p, F.length(w) + 2, F.length(p))).otherwise(p)


def source_kind(kind: Column, given: Column, default: str | None = None) -> Column:
    by_kind = F.when(kind.isin("call", "result"), "tool").when(kind.isin("observation", "patch"), "code").otherwise("conversation")
    return F.coalesce(F.when(given.isin("conversation", "document", "tool", "code", "test"), given), F.lit(default), by_kind)
