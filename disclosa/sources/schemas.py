"""The tables of the data model, as Spark schemas; codes and dates are strings, money is long."""

MANIFEST = (
    "doc_id string, corp_code string, corp_name string, listed_name string, stock_code string, industry string, sector string, "
    "doc_group string, doc_subtype string, report_nm string, rcept_no string, rcept_dt string, flr_nm string, is_correction boolean, "
    "file_path string, file_format string, n_files int, base_year int, base_month int"
)
UNIVERSE = (
    "corp_code string, stock_code string, corp_name string, listed_name string, corp_eng_name string, market string, industry string, "
    "sector_no int, sector string, listing_date string, fiscal_month string, market_cap long, n_periodic int, n_major int, "
    "n_exchange int, n_holding int, note string"
)
WARNING = "struct<doc_id:string,rel_path:string,code:string,severity:string,message:string>"
CELL = "struct<row:int,col:int,text:string,rowspan:int,colspan:int,tag:string>"
SOURCE_FILE = (
    "struct<rel_path:string,is_attachment:boolean,content_format:string,schema_version:string,content_sha256:string,"
    "declared_encoding:string,actual_encoding_used:string>"
)
NODE = (
    "struct<node_id:string,kind:string,rel_path:string,order_index:int,title_text:string,level:int,level_confident:boolean,"
    "section_hierarchy:array<string>,parent_section_id:string,end_order_index:int,text:string,is_footnote_like:boolean,"
    f"raw_rows:array<array<{CELL}>>,normalized_rows:array<array<string>>,header_row_indices:array<int>,n_declared_cols:int,"
    "actual_col_counts:array<int>,title_guess:string,unit_text:string,period_text:string,consolidation_basis:string,consolidation_reason:string>"
)
DOCUMENT = (
    f"doc_id string, doc_group string, source_files array<{SOURCE_FILE}>, nodes array<{NODE}>, warnings array<{WARNING}>, "
    "parse_quality struct<tier:string,schema_version:string,n_sanitized_entities:long,n_unresolved_section_depth:long,"
    "n_tables_with_merged_cells:long,router_matched_expected_parser:boolean>"
)
SEARCH_CHUNK = (
    "chunk_id string, case_id string, doc_id string, document_id string, document_date string, title string, source_type string, text string"
)
CHUNK_SET = "doc_id string, chunk_id string, strategy_name string, index int, text string, token_count int, node_ids array<string>, section_ids array<string>, table_ids array<string>, source_paths array<string>"
CASE = (
    "case_id string, case_title string, company struct<corp_name:string,listed_name:string,corp_code:string,stock_code:string,industry:string,sector:string>, "
    "simulation_date string, intro string, mission string, "
    "available_documents array<struct<document_id:string,doc_id:string,document_date:string,title:string,source_type:string,display_excerpt:string,original_text:string>>, "
    "evidence array<struct<evidence_id:string,document_id:string,category:string,importance:string,text:string,source_text:string,educational_reason:string>>, "
    "finance_terms array<struct<term:string,short_definition:string,source_evidence_ids:array<string>>>, "
    "decision_options array<struct<option_id:string,label:string,supporting_evidence_ids:array<string>,counter_evidence_ids:array<string>,feedback_if_missing_critical:string>>, "
    "future_events array<struct<date:string,title:string,source_document_id:string,summary:string>>, validation map<string,string>"
)
EVENT = f"struct<seq:int,kind:string,text:string,caption:string,cells:array<{CELL}>>"
PARSED = (
    "doc_id string, rel_path string, content_format string, schema_version string, content_sha256 string, declared_encoding string, "
    f"actual_encoding_used string, raw_chars long, ok boolean, error string, notes array<struct<code:string,severity:string,message:string>>, events array<{EVENT}>"
)
