"""Product names and descriptions: cleaning, tokens, comparison, standard forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HYPOTHETICAL = "hypothetical protein"
STEPS = 8
# What descriptions and names must be judged by for the same results.
UNINFORMATIVE_DESCRIPTIONS = (
    r"\bhypothetical protein\b",
    r"\buncharacteri[sz]ed protein\b",
    r"\bunknown protein\b",
    r"\bprotein of unknown function\b",
    r"\bunnamed protein product\b",
    r"\bpredicted protein\b",
    r"\bexpressed protein\b",
    r"\bconserved (?:hypothetical )?protein\b",
    r"\bwhole genome shotgun\b",
    r"\bfragment(?:s)?\b",
    r"^(?:probable|putative)\b",
)
UNINFORMATIVE_DOMAINS = (r"\bcoiled[- ]coil\b", r"\blow complexity\b", r"\bmotif\b", r"\bsignal peptide\b", r"\btransmembrane\b", r"\bdisordered\b", r"\bregion\b")
UNINFORMATIVE_PRODUCTS = ("hypothetical protein", "uncharacterized protein", "unknown protein", "protein of unknown function", "unnamed protein product", "protein", "domain-containing protein")
STOPWORDS = ("a", "and", "chain", "containing", "domain", "family", "for", "fragment", "homolog", "isoform", "like", "of", "precursor", "probable", "protein", "putative", "subunit", "the")
GENERIC = ("a", "and", "containing", "domain", "family", "homolog", "like", "of", "precursor", "probable", "protein", "putative", "related", "subfamily", "subunit", "superfamily", "the", "type")
LOCALISATIONS = ("chloroplastic", "cytosolic", "extracellular", "mitochondrial", "nuclear", "peroxisomal", "secreted")
ALIASES = (("btb poz", "btb"), ("poz btb", "btb"), ("cchc type zinc finger", "cchc"), ("zinc knuckle", "cchc"), ("rna recognition motif", "rrm"), ("rna binding domain rnp 1", "rrm"))
SPELLING = (
    ("uncharacterised", "uncharacterized"),
    ("characterisation", "characterization"),
    ("sulphur", "sulfur"),
    ("sulphate", "sulfate"),
    ("haemoglobin", "hemoglobin"),
    ("haem", "heme"),
    ("tumour", "tumor"),
    ("fibre", "fiber"),
    ("centre", "center"),
)
COMPARTMENTS = (
    "amyloplastic|chloroplastic|chloroplast|chromoplastic|cytosolic|cytoplasmic|endoplasmic reticulum|extracellular|glyoxysomal|"
    "golgi|lysosomal|mitochondrial|nuclear|peroxisomal|plasma membrane|plastidial|secreted|vacuolar"
)
COG_WORDS = (
    "biogenesis|cell cycle|cell motility|chromatin structure|coenzyme metabolism|"
    "defense mechanisms|energy production|extracellular structures|"
    "function prediction|inorganic ion transport|lipid metabolism|"
    "nucleotide metabolism|posttranslational modification|replication|"
    "secondary metabolites|signal transduction|transcription|translation|"
    "transport and metabolism"
)
SUFFIX = rf"(?i)(?:,\s*|\s+)(?:{COMPARTMENTS})(?:/(?:{COMPARTMENTS}))*(?:-like)?$"
_HOMOLOG = "(?:homolog|homologue|ortholog|orthologue|paralog|paralogue)"
_DOMAIN = r"\s+domain-containing protein"
#: Ahead: " family" in what stands before "and related proteins".
_FAMILY = r"(?=(?:(?!\s+and (?:related|similar) proteins).)*? family)"
# Fixed values: (action, pattern, replacement) in the order in which they apply; a pattern between ^ and $ is of the whole name.
FIRST_RULES = (
    ("removed_quality_prefix", r"(?i)^LOW QUALITY PROTEIN:\s*", ""),
    ("removed_quality_prefix", r"(?i)^LOW protein:\s*", ""),
)
RULES = (
    ("joined_split_hyphen", r"(?<=[A-Za-z])[ \t]+-(?=[a-z])", "-"),
    ("removed_cog_category", rf"(?i)\[(?=[^\]]*\b(?:{COG_WORDS})\b)[^\]]+\]", ""),
)
DESCRIPTION_RULES = (
    ("removed_explanatory_text", rf"(?i)^([^:]{{1,50}}):\s*an acronym for\b.*?{_DOMAIN}$", "$1 domain-containing protein"),
    ("removed_organism_name,generalized_related_proteins", rf"^(?i)(?:[A-Z][a-z]+\s+[a-z-]+\s+)?([A-Za-z][A-Za-z0-9_.-]*\d[A-Za-z0-9_.-]*)\s+and similar proteins{_DOMAIN}$", "$1 family protein"),
    ("normalized_domain_architecture", r"(?i)^(.+?\bdomain):\s*superfamily domain-containing protein$", "$1-containing protein"),
    ("removed_explanatory_text", rf"(?i)^(.+?\bdomain)\s+found in\b.*?{_DOMAIN}$", "$1-containing protein"),
    ("removed_explanatory_text", rf"(?i)^(.+?\bfamily)\s+found in\b.*?{_DOMAIN}$", "$1 protein"),
    ("generalized_related_proteins", rf"(?i)^{_FAMILY}(.+?(?:ase|protein))s\s+and (?:related|similar) proteins(?:\s+with\b.*?)?{_DOMAIN}$", "$1 protein"),
    ("generalized_related_proteins", rf"(?i)^{_FAMILY}(.+?)\s+and (?:related|similar) proteins(?:\s+with\b.*?)?{_DOMAIN}$", "$1 protein"),
    ("generalized_related_proteins", rf"(?i)^(.+?(?:ase|protein))s\s+and (?:related|similar) proteins(?:\s+with\b.*?)?{_DOMAIN}$", "$1 family protein"),
    ("generalized_related_proteins", rf"(?i)^(.+?)\s+and (?:related|similar) proteins(?:\s+with\b.*?)?{_DOMAIN}$", "$1 family protein"),
    ("removed_explanatory_text", r"(?i)^found in\s+(.+?)\s+protein family protein$", "$1 family protein"),
    ("reduced_contains_description", rf"(?i)^.+?,\s*contains?\s+(.+?\b(?:domain|repeat)|repeat|domain){_DOMAIN}$", "$1-containing protein"),
    ("reduced_contains_description", rf"(?i)^.+?,\s*contains?\s+((?:.+?\b)?repeat)s{_DOMAIN}$", "$1-containing protein"),
    ("reduced_contains_description", rf"(?i)^.+?,\s*contains?\s+(.+?){_DOMAIN}$", "$1 domain-containing protein"),
    ("removed_alternative_name", r"(?i)\s*\(or\s+[^)]+\)", ""),
    ("singularized_repeat_name", r"(?i)\brepeats-containing\b", "repeat-containing"),
    ("removed_repeated_domain_word", r"(?i)\bhomeodomain domain-containing protein\b", "homeodomain-containing protein"),
    ("removed_repeated_domain_word", r"(?i)\bdomain domain-containing protein\b", "domain-containing protein"),
    ("normalized_superfamily_name", r"(?i)\bsuperfamily domain-containing protein\b", "superfamily protein"),
)
#: For targets among the eukaryotes and names from CDD, Pfam or UniRef90; the first that fits.
BACTERIAL_RULES = (
    (rf"(?i)^bacterial surface antigen\s*\(?(D15)\)?{_DOMAIN}$", "$1 domain-containing protein"),
    (rf"(?i)^MSCRAMM family adhesin clumping factor\s+(ClfA){_DOMAIN}$", "$1-like domain-containing protein"),
    (r"(?i)^methyl-accepting chemotaxis protein\s*\(MCP\),?\s*signaling domain-containing protein$", "MCP signaling domain-containing protein"),
    (r"(?i)^type IV pilus assembly protein\s+(PilF/PilW).*?domain-containing protein$", "$1 family protein"),
    (r"(?i)^lipoprotein NlpI,?\s*contains TPR repeats.*?domain-containing protein$", "TPR repeat-containing protein"),
    (r"(?i)^pneumococcal surface protein\s+(PspC).*?domain-containing protein$", "$1-like domain-containing protein"),
    (rf"(?i)^Clostridium epsilon toxin ETX/Bacillus mosquitocidal toxin MTX2{_DOMAIN}$", "ETX/MTX2 domain-containing protein"),
    (rf"(?i)^(?:bacterial\s+)?extracellular solute-binding protein{_DOMAIN}$", "solute-binding domain-containing protein"),
    (rf"(?i)^bacterial transferase hexapeptide\s*\([^)]*\){_DOMAIN}$", "hexapeptide repeat-containing protein"),
    (rf"(?i)^bacterial\s+(PH|Ig-like){_DOMAIN}$", "$1 domain-containing protein"),
    (rf"(?i)^(RcsF)\s+lipoprotein{_DOMAIN}$", "$1-like domain-containing protein"),
    (rf"(?i)^antigen I/II family LPXTG-anchored adhesin{_DOMAIN}$", "LPXTG-anchor domain-containing protein"),
)
UNKNOWN_FUNCTION = r"(?i)\b(?:function unknown|of unknown function|plant protein \d+|uncharacteri[sz]ed conserved protein|unknown protein)\b"
LATER_RULES = (
    ("removed_localization_suffix", SUFFIX, ""),
    ("removed_database_identifier", r"(?i)\s+\b(?:COG|KOG|FOG)\d+\b$", ""),
    ("removed_locus_identifier", r"(?i)\s+(?:LOC\d+|At\d+g\d+|Os\d+g\d+)$", ""),
    ("removed_species_locus_identifier", r"(?i)\s*\([A-Z]_[A-Za-z]+_\d+\)", ""),
    ("removed_conserved_term", r"(?i)\bhelicase conserved C-terminal domain", "helicase C-terminal domain"),
    ("removed_conserved_term", r"(?i)\bplants and prokaryotes conserved\s*\(PCC\)\s+domain", "PCC domain"),
    ("removed_conserved_term", r"(?i)\s+conserved(?=\s+domain-containing protein)", ""),
    ("removed_partial_term", r"(?i)^(?:fragment|partial)\s+", ""),
    ("removed_partial_term", r"(?i)^(?!.*\btruncated hemoglobin\b)truncated\s+", ""),
    ("removed_redundant_uncertainty", r"(?i)^(?:candidate|likely|possible|potential|predicted|probable)\s+(?=.*domain-containing protein)", ""),
    # one word at most: a name that still holds the domain has lost its own
    ("normalized_uncertainty", r"(?i)^(?!.*domain-containing protein)(?:candidate|likely|possible|potential|predicted|probable)\s+", "putative "),
    ("removed_candidate_term", r"(?i)\bmesoderm development candidate\b", "mesoderm development protein"),
    ("removed_candidate_term", r"(?i)\bgolgin candidate\b", "golgin protein"),
    ("generalized_phenotype_name", r"(?i)^protein CANDIDATE G PROTEIN-COUPLED RECEPTOR\s*", "G protein-coupled receptor-like protein "),
    ("generalized_taxon_specific_name", r"(?i)^novel plant SNARE\s+", "SNARE protein "),
    ("used_hypothetical_product", r"(?i)^Orf\d+\s+protein$", HYPOTHETICAL),
    ("normalized_inactive_protein_name", r"(?i)^pseudo histidine-containing phosphotransfer protein", "inactive histidine-containing phosphotransfer protein"),
    ("removed_localization_term", r"(?i)\bsecreted\b\s*", ""),
    ("replaced_evolutionary_term", r"(?i)_HOMOLOG(?:UE)?\b", "-like protein"),
    ("generalized_phenotype_name", r"(?i)^protein HOMOLOG OF MAMMALIAN LYST-INTERACTING PROTEIN\s*", "LYST-interacting protein-like protein "),
    ("removed_acronym_expansion", r"(?i)^spen paralogue and orthologue\s+SPOC\s+", "SPOC "),
    ("removed_alternative_name", r"(?i)^(.+?)\s*;\s*solute binding domain-containing protein$", "solute-binding domain-containing protein"),
    ("shortened_multifunctional_name", r"(?i)^trifunctional UDP-glucose 4,6-dehydratase/UDP-4-keto-6-deoxy-D-glucose 3,5-epimerase/UDP-4-keto-L-rhamnose-reductase (RHM\d+)$", "multifunctional protein $1"),
    ("replaced_evolutionary_term", r"(?i)\b(DnaJ)\s+homolog(?:ue)?\s+subfamily\b", "$1 subfamily"),
)
#: Of these the first that fits.
EVOLUTIONARY_RULES = (
    (rf"(?i)^protein\s+(.+?)(?:-|\s+){_HOMOLOG}\s+([A-Za-z0-9.-]+)$", "$1-like protein $2"),
    (rf"(?i)^protein\s+(.+?)(?:-|\s+){_HOMOLOG}$", "$1-like protein"),
    (rf"(?i)^(.+?)(?:-|\s+){_HOMOLOG}(?:\s+protein)?\s+(?!protein$)([A-Za-z0-9.-]+)$", "$1-like protein $2"),
    (rf"(?i)^(.+?)(?:-|\s+){_HOMOLOG}(?:\s+protein)?$", "$1-like protein"),
    (rf"(?i)^(.+?)\s+{_HOMOLOG}\s+isoform\s+([A-Za-z0-9.-]+)$", "$1-like protein isoform $2"),
)
LAST_RULES = (
    ("replaced_semicolon", r"(?<=\w);(?=\w)", "-"),
    *(("american_spelling", rf"(?i)\b{a}\b", b) for a, b in SPELLING),
)
CHEMICAL_SYMBOLS = ("Ag", "Al", "Ca", "Cd", "Cl", "Co", "Cr", "Cu", "Fe", "Hg", "K", "Li", "Mg", "Mn", "Mo", "Na", "Ni", "Pb", "Se", "Si", "Sn", "Zn")
#: (warning, pattern that is left in a name)
AUDITS = (
    ("html_entity", r"(?i)&(?:amp|apos|gt|lt|quot);"),
    ("evolutionary_term", r"(?i)\b(?:homolog|homologue|ortholog|orthologue|paralog|paralogue)s?\b"),
    ("discouraged_uncertainty", r"(?i)\b(?:candidate|likely|possible|potential|predicted|probable)\b"),
    ("partial_or_fragment_term", r"(?i)^(?!.*\btruncated hemoglobin\b).*\b(?:fragment|partial|truncated?)\b"),
    ("localization_suffix", SUFFIX),
    ("explanatory_phrase", r"(?i)\b(?:an acronym for|and related proteins|and similar proteins|found in)\b"),
    ("forbidden_character", r'[\x00-\x1f\x7f"\\]'),
)
DATABASE_IDENTIFIER = r"(?i)\b(?:COG|FOG|KOG)\d+\b|\bEC\s+\d+\.\d+\.\d+\.\d+\b|\bGO:\d+\b"
QUALIFIED_IDENTIFIER = r"(?i)\b(?:PF\d{5}|cd\d+|cl\d+|smart\d+)\s+(?:domain-containing|family)\s+protein\b"


def squash(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def safe_product(text: Column) -> Column:
    """Without quotes and control characters; a backslash becomes a slash."""
    return squash(F.regexp_replace(F.translate(text, '\\"', "/"), r"[\x00-\x1F\x7F]", " "))


def clean_description(text: Column) -> Column:
    """A subject's description without database markers; null if it says nothing of the function."""
    ends = r"^[.;\s]+|[.;\s]+$"
    out = F.regexp_replace(squash(text), ends, "")
    for pattern in (r"(?i)^Cluster:\s*", r"(?i)^LOW QUALITY PROTEIN:\s*", r"^(?:RecName:\s*Full=|SubName:\s*Full=)", r"\s*\{ECO:[^}]+\}", r"(?i)\s*\(Fragments?\)$"):
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(out, ends, "")
    return F.when((out != "") & ~out.rlike("(?i)" + "|".join(UNINFORMATIVE_DESCRIPTIONS)), out)


def description_tokens(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*STOPWORDS)))


def unescaped(text: Column) -> Column:
    """struct<text, decoded, folded>: in the compatibility form NFKC and without HTML entities; decoded: there were some; folded: case-folded.

    An Arrow function: built-in functions know neither.
    """
    import pyarrow as pa

    def convert(texts: pa.Array) -> pa.Array:
        import html
        import unicodedata

        import pyarrow as pa

        out = []
        for t in texts.to_pylist():
            form = None if t is None else unicodedata.normalize("NFKC", t)
            plain = None if t is None else html.unescape(form)
            out.append((plain, None if t is None else plain != form, None if t is None else plain.casefold()))
        plain, decoded, folded = zip(*out, strict=True) if out else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(plain, pa.string()), pa.array(decoded, pa.bool_()), pa.array(folded, pa.string())], names=["text", "decoded", "folded"])

    convert.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(convert, "struct<text:string,decoded:boolean,folded:string>")(text)


def surface(text: Column) -> Column:
    """Case-folded words of ASCII letters and digits, joined by one space, of the text in its compatibility form without HTML entities."""
    return F.trim(F.regexp_replace(unescaped(text)["folded"], "[^a-z0-9]+", " "))


def canonical_tokens(text: Column) -> Column:
    out = surface(text)
    for phrase, alias in ALIASES:
        out = F.regexp_replace(out, rf"\b{phrase}\b", alias)
    return F.array_sort(F.array_distinct(F.filter(F.split(out, " "), lambda w: (w != "") & ~w.isin(*GENERIC))))


def specific_modifiers(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.isin(*LOCALISATIONS) | t.rlike("^[0-9]+$|^[a-z]+[0-9]+[a-z]*$"))


def _once(value: Column, f) -> Column:
    """f(value), with value evaluated once however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _state(name: Column, actions: Column) -> Column:
    return F.struct(name.alias("name"), actions.alias("actions"))


def _changed(state: Column, new: Column, action: str) -> Column:
    """The state with a new name, and the actions if it differs."""
    return _once(F.struct(state.alias("s"), new.alias("n")), lambda x: _state(x["n"], F.when(x["n"] != x["s"]["name"], F.concat(x["s"]["actions"], F.split(F.lit(action), ","))).otherwise(x["s"]["actions"])))


def _rule(action: str, pattern: str, to: str):
    return lambda s: _changed(s, F.regexp_replace(s["name"], pattern, to), action)


def _first_fit(name: Column, rules) -> Column:
    """The name after the first rule (pattern, replacement) that fits it."""
    out = F.when(F.lit(False), name)
    for pattern, to in rules:
        out = out.when(name.rlike(pattern), F.regexp_replace(name, pattern, to))
    return out.otherwise(name)


def standardise(df: DataFrame, name: Column, out: str = "std", source: Column | None = None, evidence_id: Column | None = None, organism: Column | None = None, domain: Column | None = None) -> DataFrame:
    """df with a column `out`, struct<name, actions>: a product name after all rules, each named once if it changed something.

    source and evidence_id: where the name is from; organism: the subject's, which goes; domain: of the target ('Eukaryota' ...).
    Nothing left, or a name that says nothing, is hypothetical. Null: as an empty name. The rules are functions of a state
    (name, actions), composed STEPS at a time, as an analyzer's rounds grow with the depth of one column.
    """
    empty = F.lit("")
    args = {k: F.coalesce(c, empty) if c is not None else empty for k, c in (("source", source), ("evidence_id", evidence_id), ("organism", organism), ("domain", domain))}
    source, evidence_id, organism, domain = (F.col("__args")[k] for k in args)
    literal = F.concat(F.lit(r"(?i)\b\Q"), organism, F.lit(r"\E\b"))
    foreign = (F.lower(domain) == "eukaryota") & F.lower(source).isin("cdd", "pfam", "uniref90")
    lipo = r"(?i)^(?:membrane\s+)?lipoprotein$"
    stable = F.substring_index(evidence_id, ".", 1)
    model = F.lower(source).isin("cdd", "pfam") & stable.rlike(r"(?i)^(?:PF\d{5}|cd\d+|cl\d+)$")
    says_nothing = lambda n: (n == "") | F.lower(n).isin(*UNINFORMATIVE_PRODUCTS)
    plus = lambda s, *more: F.concat(s["actions"], F.array(*map(F.lit, more)))
    steps = [
        *(_rule(*r) for r in FIRST_RULES),
        lambda s: _state(F.regexp_replace(F.trim(F.regexp_replace(F.translate(s["name"], '\\"', "/"), r"[\x00-\x20\x7f]+", " ")), "^[.;]+|[.;]+$", ""), s["actions"]),
        *(_rule(*r) for r in RULES),
        lambda s: _changed(s, F.when(organism != "", F.regexp_replace(s["name"], literal, empty)).otherwise(s["name"]), "removed_organism_name"),
        *(_rule(*r) for r in DESCRIPTION_RULES),
        lambda s: F.when(foreign & s["name"].rlike(lipo), _state(F.lit(HYPOTHETICAL), plus(s, "rejected_cross_domain_name", "used_hypothetical_product"))).otherwise(_changed(s, F.when(foreign, _first_fit(s["name"], BACTERIAL_RULES)).otherwise(s["name"]), "generalized_cross_domain_name")),
        lambda s: F.when(model & s["name"].rlike(UNKNOWN_FUNCTION), _state(F.concat(stable, F.lit(" domain-containing protein")), plus(s, "used_stable_model_identifier"))).otherwise(s),
        *(_rule(*r) for r in LATER_RULES),
        lambda s: _changed(s, _first_fit(s["name"], EVOLUTIONARY_RULES), "replaced_evolutionary_term"),
        *(_rule(*r) for r in LAST_RULES),
        lambda s: _state(F.regexp_replace(squash(s["name"]), "^[,;.]+|[,;.]+$", ""), s["actions"]),
        lambda s: _changed(s, F.when(says_nothing(s["name"]), HYPOTHETICAL).otherwise(s["name"]), "used_hypothetical_product"),
        lambda s: _changed(s, _lower_initial(s["name"]), "lowercased_initial"),
        lambda s: _state(s["name"], F.array_distinct(s["actions"])),
    ]
    df = df.withColumns({"__args": F.struct(*(c.alias(k) for k, c in args.items())), "__text": unescaped(F.coalesce(name, empty))})
    decoded = F.when(F.col("__text.decoded"), F.array(F.lit("decoded_html_entity"))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(out, _state(F.col("__text.text"), decoded))
    for k in range(0, len(steps), STEPS):
        state = F.col(out)
        for step in steps[k : k + STEPS]:
            state = _once(state, step)
        df = df.withColumn(out, state)
    return df.drop("__args", "__text")


def _lower_initial(name: Column) -> Column:
    """A first word of one capital and small letters begins small, unless it is a chemical symbol or a short one with a digit."""
    token = F.regexp_extract(name, "^([A-Z][A-Za-z0-9]*)", 1)
    keeps = (token == "") | token.isin(*CHEMICAL_SYMBOLS) | ~token.rlike("[a-z]") | F.substr(token, F.lit(2)).rlike("[A-Z]") | ((F.length(token) <= 6) & token.rlike("[0-9]"))
    return F.when(keeps, name).otherwise(F.concat(F.lower(F.substr(name, F.lit(1), F.lit(1))), F.substr(name, F.lit(2))))


def warnings(name: Column, organism: Column | None = None) -> Column:
    """What is left to look at in a standardised name."""
    tests = [(code, name.rlike(pattern)) for code, pattern in AUDITS]
    tests.append(("database_identifier", name.rlike(DATABASE_IDENTIFIER) & ~name.rlike(QUALIFIED_IDENTIFIER)))
    tests.append(("cog_category", name.rlike(rf"(?i)\[(?=[^\]]*\b(?:{COG_WORDS})\b)[^\]]+\]")))
    if organism is not None:
        tests.append(("organism_name", (F.coalesce(organism, F.lit("")) != "") & F.regexp_like(name, F.concat(F.lit(r"(?i)\b\Q"), organism, F.lit(r"\E\b")))))
    tests += [("semicolon", name.contains(";")), ("long_product_name", F.length(name) > 120)]
    return F.filter(F.array(*(F.when(t, F.lit(w)) for w, t in tests)), lambda w: w.isNotNull())


def family_id(members: Column, prefix: str) -> Column:
    """A stable name of a set: the first 12 hex digits of the SHA-256 of its members joined by NUL."""
    return F.concat(F.lit(prefix + "_"), F.substr(F.sha2(F.array_join(members, "\0"), 256), F.lit(1), F.lit(12)))
