"""Schemas of the tables that readers give and operators take."""

SEQUENCES = "seq_no bigint, id string, description string, sequence string"
FEATURES = (
    "row_no bigint, seqid string, source string, type string, start bigint, end bigint, score string, strand string, "
    "phase string, attributes_text string, attributes map<string,string>, id string, parents array<string>"
)
PASSTHROUGH = "line_no bigint, section string, line string"
ANNOTATION = "ID string, Description string, Locus_tag string"
HITS = "database string, qseqid string, sseqid string, pident double, qlen bigint, slen bigint, qcovhsp double, scovhsp double, evalue double, bitscore double"
HIT_METADATA = (
    "database string, subject_id string, description string, weight double, subject_taxon_id bigint, "
    "subject_organism string, taxonomy_relation string, taxonomy_weight double"
)
DOMAINS = "query_id string, name string, accession string, hmm_length bigint, i_evalue double, bitscore double, hmm_from bigint, hmm_to bigint, description string"
MSS_ROWS = "line_no bigint, entry string, block_no bigint, feature string, location string, qualifier string, value string"
