"""Writers: replaced tables, landed raw rows, manifests, quarantine, reports, layers and views."""
