"""minutebook: meeting-archive table work as Spark DataFrame operators.

Column functions live in ``minutebook.functions``, DataFrame operators in
``minutebook.operators``, readers and writers in ``minutebook.sources`` and
the incremental index in ``minutebook.streaming``.  The names below are the
ones most pipelines use.
"""
from .functions.dates import (file_date_key, folder_year, meeting_key, parse_date, part_no,  # noqa: F401
                              recording_date, with_page_date)
from .functions.text import clean_text, minutes, strip, truncate_for_prompt, truncate_text, word_count  # noqa: F401
from .functions.tokens import token_count, tokens  # noqa: F401
from .operators.assemble import assemble_text, assemble_transcript, roster_for  # noqa: F401
from .operators.catalog import (best_candidate, best_version, derived_names, has_text,  # noqa: F401
                                meeting_folders, pending, pending_pdfs, plan_moves)
from .operators.chunk import paragraph_chunks, segment_plan, token_chunks  # noqa: F401
from .operators.model import attach_responses, build_requests, fuse, plan_stages, run_model  # noqa: F401
from .operators.parse import parse_decisions, parse_sections, placeholder  # noqa: F401
from .operators.qc import (check_complete, check_dates, check_durations, check_names,  # noqa: F401
                           check_readable, check_repeats, check_short, check_support, check_terms, qc_report)
from .operators.report import (attendees_by_date, index_rows, meeting_manifest, merge_report,  # noqa: F401
                               merge_report_long, organization_report, recording_index, run_stats)
from .operators.segment import (assign_meetings, assign_meetings_bucketed, classify_pages,  # noqa: F401
                                first_files, is_start, number_pages, page_evidence)
from .session import checkpoint_dir, get_session  # noqa: F401
from .sources.io import append_index, list_files, read_table, write_by_meeting, write_csv, write_documents  # noqa: F401
from .streaming.index import stream_index  # noqa: F401
