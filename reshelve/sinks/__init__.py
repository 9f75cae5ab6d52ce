"""Writers for staged tables, documents, wide rows and reports."""
