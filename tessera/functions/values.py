"""Pattern lists, weights and maps that results depend on. Patterns are written as Unicode-aware regular expressions."""

# --- fixed values: URL patterns in order of precedence, and the content type each stands for
URL_TYPES = (
    (r"arxiv\.org/(abs|pdf|html)/\d", "research_paper"),
    (r"aclanthology\.org/\d{4}\.\w+-\w+", "research_paper"),
    (r"openreview\.net/forum", "research_paper"),
    (r"semanticscholar\.org/paper", "research_paper"),
    (r"ncbi\.nlm\.nih\.gov/(pmc|pubmed)", "research_paper"),
    (r"github\.com/[^/]+/[^/]+/(blob|tree)/", "source_code"),
    (r"github\.com/[^/]+/[^/]+/?$", "source_code"),
    (r"\.(py|rs|go|c|cpp|h|ts|js|java|rb|swift|zig|lua|ml|hs)$", "source_code"),
    (r"readthedocs\.(io|org)", "technical_doc"),
    (r"docs\.(python|rust-lang|golang|pytorch|tensorflow|numpy)\.", "technical_doc"),
    (r"developer\.mozilla\.org", "technical_doc"),
    (r"wikipedia\.org/wiki/", "encyclopedia"),
    (r"stackoverflow\.com/questions/\d", "technical_qa"),
    (r"stackexchange\.com/questions/\d", "technical_qa"),
    (r"distill\.pub", "research_paper"),
    (r"paulgraham\.com", "long_form_essay"),
    (r"(huggingface|lilianweng)", "research_blog"),
    (r"(medium|substack)\.com", "blog_post"),
    (r"(reddit|news\.ycombinator)\.com", "forum_post"),
    (r"(twitter|instagram|tiktok|facebook)\.com", "social_media"),
)
# --- fixed values: text patterns, case-insensitive or not, the content type, and matches a word that it takes
TEXT_TYPES = (
    (r"\b(abstract|introduction|related work|methodology|conclusion|references)\b", True, "research_paper", 0.003),
    (r"\b(def |class |fn |impl |func |function |#include|import |from .+ import)\b", False, "source_code", 0.005),
    (r"\b(theorem|lemma|proof|corollary|proposition)\b", True, "research_paper", 0.002),
    (r"\b(dataset|benchmark|baseline|ablation|evaluation|epoch|batch_size)\b", True, "research_paper", 0.004),
    (r"\bparameters?\b.*\bmodel\b|\bmodel\b.*\bparameters?\b", True, "research_paper", 0.002),
)
# --- fixed values: signal patterns (pattern, case-insensitive)
SIGNAL_REWARDS = (
    (r"\bfigure \d+\b", True),
    (r"\b(theorem|lemma|proof|corollary|proposition)\b", True),
    (r"\b(algorithm|complexity|O\(n\))\b", True),
    (r"\b(dataset|experiment|baseline|benchmark|ablation)\b", True),
    (r"\b(def |class |fn |impl |func )\b", False),
    (r"\breferences?\b", True),
    (r"\b(section|subsection|appendix)\s+\d", True),
    (r"\b(loss|gradient|backprop|optimizer|epoch|batch)\b", True),
    (r"\b(precision|recall|F1|accuracy|BLEU|ROUGE|perplexity)\b", True),
    (r"\b(assert|unittest|pytest|test_)\b", False),
    (r"\b(API|REST|endpoint|schema|interface)\b", True),
    (r"[A-Z][a-z]+\s+et\s+al\.", True),
    (r"\d{4}\.\d{4,5}", False),
)
SIGNAL_PENALTIES = (
    (r"click here", True),
    (r"sign up (now|today|free)", True),
    (r"limited time offer", True),
    (r"subscribe (now|to our newsletter)", True),
    (r"\bcookie policy\b", True),
    (r"\baffiliate\b", True),
    (r"\bsponsored\b", True),
    (r"all rights reserved", True),
    (r"\bprivacy policy\b", True),
    (r"(buy now|add to cart|checkout)", True),
    (r"[^\w\s]{8,}", False),
    (r"(\b\w+\b)( \1){4,}", True),
)
# --- fixed values: base of the signal score for each URL type
SIGNAL_BASE = {
    "research_paper": 0.9, "source_code": 0.85, "technical_doc": 0.8, "encyclopedia": 0.7, "technical_qa": 0.7, "research_blog": 0.7,
    "long_form_essay": 0.65, "technical_blog": 0.6, "blog_post": 0.45, "forum_post": 0.3, "social_media": 0.05,
}
SIGNAL_BASE_OTHER = 0.4
# --- fixed values: quality patterns, all case-insensitive
QUALITY_REWARDS = (
    r"\bfigure \d+\b",
    r"\b(theorem|lemma|proof|corollary)\b",
    r"\b(abstract|introduction|conclusion|methodology)\b",
    r"\b(def |class |fn |func |function |impl )\b",
    r"\b(algorithm|complexity|runtime|O\(n\))\b",
    r"\b(dataset|experiment|baseline|benchmark|evaluation)\b",
    r"\breferences?\b",
)
QUALITY_PENALTIES = (
    r"click here",
    r"sign up (now|today|free)",
    r"limited time offer",
    r"subscribe (now|to our newsletter)",
    r"\bcookie policy\b",
    r"all rights reserved",
    r"\baffiliate\b",
    r"\bsponsored\b",
    r"\bad\b",
)
# --- fixed values: domain rules in order (pattern, weight, category)
DOMAINS = (
    ("arxiv.org", 2.5, "research_paper"),
    ("aclanthology.org", 2.5, "research_paper"),
    ("openreview.net", 2.2, "research_paper"),
    ("semanticscholar.org", 2.0, "research_paper"),
    ("distill.pub", 2.8, "research_paper"),
    ("ncbi.nlm.nih.gov", 2.0, "research_paper"),
    ("github.com", 2.0, "source_code"),
    ("readthedocs.io", 1.8, "documentation"),
    ("docs.python.org", 1.8, "documentation"),
    ("developer.mozilla.org", 1.8, "documentation"),
    ("wikipedia.org", 1.5, "encyclopedia"),
    ("stackoverflow.com", 1.6, "technical_qa"),
    ("stackexchange.com", 1.5, "technical_qa"),
    ("paulgraham.com", 1.8, "long_form_essay"),
    ("lilianweng.github.io", 2.0, "research_blog"),
    ("huggingface.co/blog", 1.6, "technical_blog"),
    ("huggingface.co", 1.9, "dataset"),
    ("medium.com", 0.9, "blog"),
    ("substack.com", 1.0, "blog"),
    ("hackernews", 0.8, "link_aggregator"),
    ("reddit.com", 0.4, "forum"),
    ("twitter.com", 0.1, "social_media"),
    ("facebook.com", 0.05, "social_media"),
    ("instagram.com", 0.0, "social_media"),
    ("tiktok.com", 0.0, "social_media"),
    ("news.google.com", 0.3, "news_aggregator"),
    ("*", 0.8, "general_web"),
)
# --- fixed values: weights of content types and of code languages; "unknown" is the default
TYPE_WEIGHTS = {
    "source_code": 2.0, "research_paper": 2.0, "technical_doc": 1.8, "framework_doc": 1.7, "report": 1.6, "study": 1.6, "encyclopedia": 1.4, "textbook": 1.8,
    "long_form_essay": 1.4, "technical_qa": 1.3, "tutorial": 1.2, "blog_post": 0.9, "news_article": 0.7, "forum_post": 0.5, "social_media": 0.1, "unknown": 0.8,
}
LANGUAGE_WEIGHTS = {
    "python": 2.0, "rust": 1.9, "c": 1.8, "cpp": 1.8, "go": 1.7, "typescript": 1.6, "javascript": 1.3, "java": 1.4, "haskell": 1.8, "ocaml": 1.7, "zig": 1.8,
    "lua": 1.3, "bash": 1.2, "sql": 1.4, "r": 1.3, "julia": 1.5, "unknown": 1.0,
}
# --- fixed values: path suffixes of code languages
CODE_SUFFIXES = {
    ".py": "python", ".rs": "rust", ".go": "go", ".c": "c", ".h": "c", ".cpp": "cpp", ".cc": "cpp", ".cxx": "cpp", ".ts": "typescript", ".js": "javascript",
    ".java": "java", ".rb": "ruby", ".swift": "swift", ".zig": "zig", ".lua": "lua", ".ml": "ocaml", ".hs": "haskell", ".jl": "julia", ".r": "r", ".sql": "sql",
    ".sh": "bash", ".bash": "bash",
}
# --- fixed values: file suffixes taken from repositories
REPO_CODE_SUFFIXES = (".py", ".rs", ".go", ".c", ".h", ".cpp", ".cc", ".cxx", ".hpp", ".ts", ".js", ".java", ".rb", ".swift", ".zig", ".lua", ".ml", ".hs", ".jl", ".r", ".sql", ".sh", ".bash")
REPO_DOC_SUFFIXES = (".md", ".rst", ".txt", ".adoc")
REPO_MAX_BYTES = 500_000
# --- fixed values: keywords by which texts of unknown type are classified; two of a list decide
TYPE_KEYWORDS = (
    (("abstract", "introduction", "methodology", "conclusion", "references", "theorem", "lemma"), "research_paper"),
    (("def ", "class ", "fn ", "impl ", "function ", "#include", "import ", "from . import"), "source_code"),
    (("parameters", "returns", "example usage", "api reference", "install", "pip install"), "technical_doc"),
    (("dataset", "benchmark", "experiment", "evaluation", "accuracy", "f1 score"), "research_paper"),
    (("chapter ", "section ", "textbook", "exercise ", "problem set"), "textbook"),
    (("press release", "breaking news", "reported", "journalist"), "news_article"),
)
# --- fixed values: refusal patterns by group, each with its weight; all case-insensitive
REFUSALS = {
    "hard_refusals": (1.0, (
        r"i (can't|cannot|won't|will not|am unable to) (help|assist|answer|provide|do|complete|fulfill|support)",
        r"i('m| am) not able to",
        r"i('m| am) unable to",
        r"i must (decline|refuse)",
        r"i (decline|refuse) to",
        r"that('s| is) (not something i|something i (can|will) not)",
        r"i('m| am) (not allowed|not permitted) to",
        r"this (request |query )?(is|falls) (outside|beyond) (my|what i)",
    )),
    "ai_watermarks": (1.0, (
        r"as an ai( language)? model",
        r"i('m| am) (an ai|a large language model|an llm|a chatbot|an artificial intelligence)",
        r"i('m| am) claude",
        r"i('m| am) chatgpt",
        r"i('m| am) gpt-?(2|3|4|4o)?",
        r"i('m| am) (bard|gemini|copilot|mistral ai|llama)",
        r"openai('s)? (policy|guidelines|terms|usage)",
        r"anthropic('s)? (policy|guidelines|terms|usage)",
    )),
    "safety_hedges": (0.7, (
        r"i (must|want to|need to|should) (caution|warn|note|point out|remind you|emphasize)",
        r"it('s| is) important to (note|remember|consider|understand|be aware)",
        r"please (be aware|note|keep in mind|remember) that",
        r"i (strongly )?encourage you to",
        r"(please )?(consult|speak (to|with)|see) a (professional|doctor|therapist|lawyer|expert|licensed)",
        r"this (information|content|topic|request) (may|might|could) be (harmful|dangerous|sensitive)",
    )),
    "moral_grandstanding": (0.6, (
        r"this (is|would be|could be) (harmful|dangerous|unethical|inappropriate|illegal|irresponsible)",
        r"(promoting|encouraging|facilitating) (harm|violence|illegal|unethical)",
        r"i('m| am) (concerned|worried) about",
        r"it('s| is) (not|never) okay to",
        r"(this|that) crosses (a|the) line",
        r"i (must|need to) (prioritize|ensure) (safety|your wellbeing|ethical)",
    )),
    "soft_deflections": (0.5, (
        r"instead,? (i('d| would) (suggest|recommend|encourage|like to))",
        r"have you (considered|thought about)",
        r"perhaps (you could|consider|try|a better)",
        r"a (better|safer|healthier|more appropriate) (approach|alternative|option) (would|might) be",
        r"i('d| would) (be happy to|love to) help (with|you) (something|a different|another)",
    )),
    "content_policy_language": (0.8, (
        r"(violates?|goes? against|contrary to) (my |our )?(guidelines|policy|policies|terms|content policy|usage policy)",
        r"(community|content) (guidelines|standards|policies)",
        r"terms of (service|use)",
        r"acceptable use",
        r"responsible (ai|use)",
    )),
}
INSTANT_DROPS = (
    r"^\s*(i (can.t|cannot|won.t|will not|am unable to) (help|assist|answer|provide|do|complete|fulfill|support))\b",
    r"^\s*(i must (decline|refuse)|i (decline|refuse) to)\b",
    r"^\s*(as an ai( language)? model)\b",
    r"this conversation (may be|is being) (monitored|recorded) for (safety|training)",
    r"i('ve| have) been (trained|designed|programmed) (by|to)",
    r"my (training|guidelines|instructions) (prevent|prohibit|don't allow)",
    r"as a responsible ai",
)
# --- fixed values: URL patterns that crawls keep to, and those they avoid
URL_ALLOW = (
    r"github\.com", r"arxiv\.org", r"wikipedia\.org", r"readthedocs\.io", r"docs\.python\.org", r"developer\.mozilla\.org", r"stackoverflow\.com/questions", r"stackexchange\.com",
    r"paulgraham\.com", r"distill\.pub", r"lilianweng\.github\.io", r"huggingface\.co/blog", r"openreview\.net", r"semanticscholar\.org", r"ncbi\.nlm\.nih\.gov", r"aclanthology\.org", r"owasp\.org",
)
URL_BLOCK = (
    r"login", r"signup", r"register", r"checkout", r"cart", r"facebook\.com", r"twitter\.com", r"instagram\.com", r"tiktok\.com", r"pinterest\.com", r"reddit\.com/r/memes", r"amazon\.com", r"ebay\.com",
)
# --- fixed values: special tokens of the byte tokenizer, ids from 0; byte b is id 6 + b
SPECIAL_TOKENS = ("<|pad|>", "<|unk|>", "<|bos|>", "<|eos|>", "<|sep|>", "<|mask|>")
EOS_ID = 3
BYTE_BASE = 6
