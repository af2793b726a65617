"""The data model as composable DataFrame functions, layer by layer."""
