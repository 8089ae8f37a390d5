"""Sources and sinks: markup, law documents, files of other forms, pages of the corpora, manifests."""
