"""Writers and stored-document shapes."""
