from trailmine.sinks.text import (
    level_lines,
    replace_suggestions,
    write_field_counts,
    write_level,
    write_suggestions,
)

__all__ = ["level_lines", "replace_suggestions", "write_field_counts", "write_level", "write_suggestions"]
