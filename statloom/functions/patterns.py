"""Pattern catalogues and weights. Catalogues are data: profile -> category -> alternatives in order.

Fixed values: all patterns, weights and limits in this module must equal those of the system whose results we match.
Patterns are written in the syntax that Java, RE2 and Python share; dialect.py adapts classes and flags.
"""

from __future__ import annotations

CATEGORIES = ("p_values", "sample_sizes", "confidence_intervals", "effect_sizes", "statistical_tests", "power_analysis", "corrections")

#: The patterns as implemented, ignoring case.
IMPLEMENTED = {
    "p_values": [
        r"[Pp]\s*[<>=≤≥]\s*0?\.?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?",
        r"[Pp]\s*\(\s*[<>=≤≥]\s*0?\.?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?\s*\)",
        r"[Pp][-\s]?value[s]?\s*[<>=≤≥]\s*0?\.?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?",
        r"[Pp]\s*=\s*NS",
        r"[Pp]\s*=\s*n\.?s\.?",
        r"significance\s+at\s+[Pp]\s*[<>=≤≥]\s*0?\.?\d+",
    ],
    "sample_sizes": [
        r"[nN]\s*=\s*[\d,]+",
        r"[nN]\s*\(\w+\)\s*=\s*[\d,]+",
        r"sample\s+size\s*:?\s*[\d,]+",
        r"[\d,]+\s+(?:patients?|participants?|subjects?|cases?|controls?)",
        r"total\s+[nN]\s*=\s*[\d,]+",
    ],
    "confidence_intervals": [
        r"\d+(?:\.\d+)?%?\s*CI[\s:]+\[?[\d.-]+\s*[,;]\s*[\d.-]+\]?",
        r"\d+(?:\.\d+)?%?\s*confidence\s+interval[\s:]+\[?[\d.-]+\s*[,;]\s*[\d.-]+\]?",
        r"CI\s*\d+%?\s*[=:]\s*\[?[\d.-]+\s*(?:to|-|–|—)\s*[\d.-]+\]?",
        r"\[[\d.-]+\s*[,;]\s*[\d.-]+\]\s*\(?(?:95|99)%?\s*CI\)?",
    ],
    "effect_sizes": [
        r"Cohen'?s?\s*d\s*[=:]\s*[\d.-]+",
        r"d\s*=\s*[\d.-]+\s*\(?(?:small|medium|large)?\)?",
        r"OR\s*[=:]\s*[\d.-]+(?:\s*\[[\d.-]+\s*[,;]\s*[\d.-]+\])?",
        r"RR\s*[=:]\s*[\d.-]+(?:\s*\[[\d.-]+\s*[,;]\s*[\d.-]+\])?",
        r"HR\s*[=:]\s*[\d.-]+(?:\s*\[[\d.-]+\s*[,;]\s*[\d.-]+\])?",
        r"r\s*[=]\s*[+-]?0?\.?\d+",
        r"R\^?2\s*[=]\s*0?\.?\d+",
        r"β\s*[=]\s*[\d.-]+",
        r"beta\s*[=]\s*[\d.-]+",
    ],
    "statistical_tests": [
        r"t\s*\(\s*\d+(?:\.\d+)?\s*\)\s*[=]\s*[\d.-]+",
        r"t[-\s]?test",
        r"paired[-\s]?samples?\s+t[-\s]?test",
        r"F\s*\(\s*\d+\s*,\s*\d+\s*\)\s*[=]\s*[\d.-]+",
        "ANOVA",
        "ANCOVA",
        "MANOVA",
        r"χ2?\s*\(\s*\d+\s*\)\s*[=]\s*[\d.-]+",
        r"chi[-\s]?squared?\s*[=]\s*[\d.-]+",
        r"Mann[-\s]?Whitney",
        "Wilcoxon",
        r"Kruskal[-\s]?Wallis",
        r"regression\s+coefficient",
        "Bonferroni",
        r"Fisher'?s?\s+exact",
        r"Shapiro[-\s]?Wilk",
        r"Kolmogorov[-\s]?Smirnov",
    ],
    "power_analysis": [
        r"power\s*[=:]\s*0?\.?\d+",
        r"statistical\s+power\s*[=:]\s*0?\.?\d+",
        r"achieved\s+power\s*[=:]\s*0?\.?\d+",
        r"post[-\s]?hoc\s+power",
        r"1\s*-\s*β\s*[=:]\s*0?\.?\d+",
    ],
    "corrections": [
        r"Bonferroni[-\s]?(?:corrected|adjusted)",
        r"False\s+Discovery\s+Rate",
        r"FDR[-\s]?(?:corrected|adjusted)",
        r"Benjamini[-\s]?Hochberg",
        r"q[-\s]?value\s*[<>=]\s*0?\.?\d+",
    ],
}

#: The patterns as documented, case counting.
DOCUMENTED = {
    "p_values": [
        r"[pP]\s*[<>=≤≥]\s*0?\.\d+",
        r"[pP]\s*=\s*0?\.\d+",
        r"[pP]-value[s]?\s*[:<>=≤≥]\s*0?\.\d+",
        r"[pP]\s*\([^)]*\)\s*[<>=]\s*0?\.\d+",
        r"[pP]\s*value\s+of\s+0?\.\d+",
        r"significant\s+at\s+[pP]\s*[<>=]\s*0?\.\d+",
        r"[pP]\s*\(\s*two-tailed\s*\)\s*[<>=]\s*0?\.\d+",
    ],
    "sample_sizes": [
        r"[nN]\s*=\s*\d+",
        r"sample\s+size\s*[:=]\s*\d+",
        r"\d+\s+participants?",
        r"\d+\s+subjects?",
        r"\d+\s+patients?",
        r"\d+\s+cases?\s+and\s+\d+\s+controls?",
    ],
    "confidence_intervals": [
        r"95%?\s*CI[\s:]+[\[\(]?\s*-?\d+\.?\d*\s*[-,to]\s*-?\d+\.?\d*[\]\)]?",
        r"CI\s*[\[\(]-?\d+\.?\d*\s*,\s*-?\d+\.?\d*[\]\)]",
        r"confidence\s+interval[\s:]+[\[\(]?\s*-?\d+\.?\d*\s*[-,to]\s*-?\d+\.?\d*[\]\)]?",
    ],
    "effect_sizes": [
        r"Cohen's\s*d\s*=\s*-?\d+\.?\d*",
        r"[dg]\s*=\s*-?\d+\.?\d*",
        r"η²\s*=\s*0?\.\d+",
        r"[rR]²?\s*=\s*-?0?\.\d+",
        r"odds?\s+ratio\s*[\[\(]?OR[\]\)]?\s*[=:]\s*\d+\.?\d*",
        r"hazard\s+ratio\s*[\[\(]?HR[\]\)]?\s*[=:]\s*\d+\.?\d*",
    ],
    "statistical_tests": [
        "t-test",
        "Mann-Whitney",
        "Wilcoxon",
        "ANOVA",
        "ANCOVA",
        "chi-square",
        "χ²",
        r"Fisher['s]?\s+exact",
        "Kruskal-Wallis",
        "regression",
        "correlation",
        "Pearson",
        "Spearman",
    ],
    "power_analysis": [
        r"power\s*[=:]\s*0?\.\d+",
        r"statistical\s+power\s+of\s+0?\.\d+",
        r"\d+%\s+power",
    ],
    "corrections": [
        "Bonferroni",
        "Holm",
        "FDR",
        r"false\s+discovery\s+rate",
        "Benjamini-Hochberg",
        "Tukey",
        "Dunnett",
    ],
}

#: Profile -> (catalogue, ignore case).
CATALOGUES = {"implemented": (IMPLEMENTED, True), "documented": (DOCUMENTED, False)}

#: Points a category gives.
WEIGHTS = {
    "implemented": {"p_values": 25, "sample_sizes": 25, "confidence_intervals": 20, "effect_sizes": 20, "statistical_tests": 10},
    "documented": {"p_values": 30, "confidence_intervals": 20, "effect_sizes": 15, "sample_sizes": 10, "statistical_tests": 10, "power_analysis": 10, "corrections": 5},
}

#: Name -> (pattern with groups, type).
STRUCTURED = {
    "ci_parentheses": (r"(\d+\.?\d*)\s*\((\d+\.?\d*)\s*[,-]\s*(\d+\.?\d*)\)", "confidence_interval"),
    "ci_brackets": (r"\[(\d+\.?\d*)\s*[,-]\s*(\d+\.?\d*)\]", "confidence_interval"),
    "ci_to": (r"(\d+\.?\d*)\s+to\s+(\d+\.?\d*)", "confidence_interval"),
    "ci_between": (r"between\s+(\d+\.?\d*)\s+and\s+(\d+\.?\d*)", "confidence_interval"),
    "ci_explicit": (r"(CI|confidence\s+interval)[:\s]+(\d+\.?\d*)\s*[,-]\s*(\d+\.?\d*)", "confidence_interval"),
    "p_value_exact": (r"[Pp]\s*[=<>≤≥]\s*(\d+\.?\d*)", "p_value"),
    "p_value_text": (r"(significant|significance)\s+at\s+(\d+\.?\d*)\s+level", "p_value"),
    "sample_size": (r"[nN]\s*=\s*(\d+)", "sample_size"),
    "participants": (r"(\d+)\s+(participants?|patients?|subjects?|individuals?|cases?)", "sample_size"),
    "cohens_d": (r"Cohen's\s+d\s*=\s*(\d+\.?\d*)", "effect_size"),
    "odds_ratio": (r"(OR|odds\s+ratio)\s*[=:]\s*(\d+\.?\d*)", "effect_size"),
    "correlation": (r"[rR]\s*=\s*[+-]?(\d+\.?\d*)", "effect_size"),
    "t_test": (r"t\s*\(\s*(\d+)\s*\)\s*=\s*(\d+\.?\d*)", "statistical_test"),
    "f_test": (r"F\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)\s*=\s*(\d+\.?\d*)", "statistical_test"),
    "chi_square": (r"χ²\s*\(\s*(\d+)\s*\)\s*=\s*(\d+\.?\d*)", "statistical_test"),
}
#: Names whose type changes where every name holding "ci" is an interval.
COMPAT_TYPES = {"participants": "confidence_interval"}

#: Marks of tables and figures.
TABLE_MARKS = [r"Table\s+\d+[:\.]", r"TABLE\s+\d+", r"\|.*\|.*\|", "┌─.*─┐", r"<table.*?>.*?</table>"]
FIGURE_MARKS = [r"Figure\s+\d+[:\.].*?(?=Figure\s+\d+|Table\s+\d+|$)", r"FIGURE\s+\d+.*?(?=FIGURE\s+\d+|TABLE\s+\d+|$)", r"Fig\.\s+\d+.*?(?=Fig\.\s+\d+|Table\s+\d+|$)"]
#: Characters before and after a table mark that belong to its section.
TABLE_WINDOW = (100, 500)

#: Looser patterns of the audit of counts.
AUDIT_A = {
    "p_values": [
        r"[Pp]\s*[<>=≤≥]\s*0?\.?\d+",
        r"[Pp][-\s]?value[s]?\s*[<>=≤≥]\s*0?\.?\d+",
    ],
    "sample_sizes": [
        r"[nN]\s*=\s*[\d,]+",
        r"sample\s+size\s*:?\s*[\d,]+",
    ],
    "confidence_intervals": [
        r"\d+%?\s*CI[\s:]+\[?[\d.-]+\s*[,;]\s*[\d.-]+\]?",
    ],
    "effect_sizes": [
        r"Cohen'?s?\s*d\s*[=:]\s*[\d.-]+",
        r"OR\s*[=:]\s*[\d.-]+",
        r"RR\s*[=:]\s*[\d.-]+",
    ],
    "t_tests": [
        r"t\s*\(\s*\d+\s*\)\s*[=]\s*[\d.-]+",
        r"t[-\s]?test",
    ],
}
#: The wide catalogue of the audit of low scores.
AUDIT_B = {
    "p_values": [
        r"p\s*[<>=]\s*0?\.\d+",
        r"P\s*[<>=]\s*0?\.\d+",
        r"significance.*0\.\d+",
        r"significant\s+at\s+0\.\d+",
        r"p-value.*0\.\d+",
    ],
    "sample_sizes": [
        r"[nN]\s*=\s*\d+",
        r"\d+\s+patients",
        r"\d+\s+subjects",
        r"\d+\s+participants",
        r"sample.*\d+",
        r"recruited\s+\d+",
        r"enrolled\s+\d+",
    ],
    "confidence_intervals": [
        r"95%\s*CI",
        r"99%\s*CI",
        r"confidence\s+interval",
        r"CI\s*:?\s*\[",
        r"CI\s*:?\s*\(",
    ],
    "effect_sizes": [
        r"d\s*=\s*[\d.-]+",
        r"[Ee]ffect\s+size",
        r"OR\s*[:=]",
        r"HR\s*[:=]",
        r"RR\s*[:=]",
        r"[Cc]orrelation.*r\s*=",
    ],
    "statistical_tests": [
        "t-test",
        "ANOVA",
        "[Cc]hi-square",
        "[Mm]ann-[Ww]hitney",
        "[Ww]ilcoxon",
        "[Kk]ruskal",
        "regression",
        "[Ff]isher.*exact",
    ],
}
#: The quick search of the audit of medium scores.
AUDIT_C = {
    "p_values": [
        r"[Pp]\s*[<>=]\s*0?\.\d+",
    ],
    "sample_sizes": [
        r"[nN]\s*=\s*\d+",
    ],
    "confidence_intervals": [
        r"95%\s*CI",
        r"confidence\s+interval",
    ],
    "effect_sizes": [
        r"OR\s*[:=]",
        r"HR\s*[:=]",
        r"RR\s*[:=]",
    ],
    "statistical_tests": [
        "t-test",
        "ANOVA",
        "chi-square",
        "regression",
    ],
}
#: How far into a text the audits with cuts look, and how many items they check.
AUDIT_CHARS = {"count_match": 50_000, "presence": 100_000, "missed_low": 100_000, "missed_medium": 50_000}
AUDIT_ITEMS = 10

#: Content flags of an article for grouping.
CONTENT_FLAGS = {"has_ci": r"CI[:=\s]|confidence interval", "has_pvalues": r"p\s*[<>=]\s*0\.\d+", "has_sample_size": r"n\s*=\s*\d+"}
#: Words that mark a research article, and how far into a text they are looked for.
RESEARCH_WORDS = ("methods", "results", "statistical analysis", "data analysis")
RESEARCH_CHARS = 10_000
#: Body length below which a size class ends, its name and the most articles in one of its batches.
SIZE_CLASSES = ((10_000, "short", 50), (50_000, "medium", 25), (100_000, "long", 10), (None, "very_long", 5))
#: Fixed value: tokens of a batch.
TARGET_TOKENS = 8000
